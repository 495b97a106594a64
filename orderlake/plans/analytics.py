"""Questions asked of the curated sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.functions.dates import day_partition, day_text
from orderlake.functions.measures import order_count, revenue
from orderlake.functions.scalars import mean_money



def pruned_single_day(sales: DataFrame, day: str) -> DataFrame:
    """One day by its partition columns: the other days are not even listed."""
    return sales.where(day_partition(day)).agg(order_count(), revenue())


def full_scan_same_answer(sales: DataFrame, day: str) -> DataFrame:
    """The same day by a derived value. It cannot be pruned and is kept for comparison."""
    return sales.where(day_text(F.col("order_date")) == day).agg(order_count(), revenue())


def single_column_projection(sales: DataFrame) -> DataFrame:
    return sales.agg(revenue())


def many_column_projection(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.count("*").alias("rows_seen"),
        F.min("order_id").alias("first_order"),
        F.max("status").alias("last_status"),
        F.min("product_name").alias("first_product"),
        F.max("country").alias("last_country"),
    )


def revenue_by_category(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("category")
        .agg(
            order_count(),
            revenue(),
            mean_money(F.sum("order_total"), F.count("order_total")).alias("avg_order"),
        )
        .orderBy(F.col("revenue").desc(), "category")
    )


def top_customers_by_country(sales: DataFrame, places: int = 3) -> DataFrame:
    """Customers ranked inside their country, ties kept.

    The rank filter is pushed below the shuffle, so a country sends its best few
    customers of each task and not all of them.
    """
    totals = sales.groupBy("country", "customer_id").agg(revenue())
    rank = F.rank().over(Window.partitionBy("country").orderBy(F.col("revenue").desc()))
    return (
        totals.withColumn("rnk", rank)
        .where(F.col("rnk") <= places)
        .orderBy("country", "rnk", "customer_id")
    )


def buyers_by_country(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Curated fact joined to the raw customer file: distinct buyers and revenue.

    Revenue is summed per customer before the join, so the fact is shuffled once,
    combined, and a customer with a third of all orders is one row by then.
    """
    per_customer = sales.groupBy("customer_id").agg(F.sum("order_total").alias("spent"))
    named = customers.select("customer_id", "country")
    return (
        per_customer.join(named, "customer_id")
        .groupBy("country")
        .agg(F.countDistinct("customer_id").alias("buyers"), F.sum("spent").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "country")
    )


def category_country_summary(sales: DataFrame) -> DataFrame:
    """The aggregate worth materialising: every later read of it skips the fact."""
    return sales.groupBy("category", "country").agg(order_count(), revenue())


def summary_by_category(summary: DataFrame) -> DataFrame:
    return (
        summary.groupBy("category")
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "category")
    )
