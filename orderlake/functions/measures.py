"""The measures every report uses."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_count() -> Column:
    return F.count("*").alias("orders")


def revenue() -> Column:
    return F.sum("order_total").alias("revenue")


def units() -> Column:
    return F.sum("quantity").alias("units")
