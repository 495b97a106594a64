"""Profiles and joins over the raw tables, as asked before anything is cleaned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.contract import ORDER_DATE_FORMAT
from orderlake.functions.dates import day_partition, day_text, partition_key
from orderlake.functions.measures import units
from orderlake.functions.scalars import blank_to_null, parse_timestamp, to_int


def status_totals(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("status").agg(F.count("*").alias("orders"), units()).orderBy("status")
    )


def status_totals_one_day(orders: DataFrame, day: str) -> DataFrame:
    return status_totals(orders.where(day_partition(day)))


def units_total(orders: DataFrame) -> DataFrame:
    return orders.agg(units())


def raw_profile(orders: DataFrame) -> DataFrame:
    """Rows, distinct ids and distinct partitions."""
    return orders.agg(
        F.count("*").alias("raw_rows"),
        F.countDistinct("order_id").alias("distinct_ids"),
        F.countDistinct(partition_key()).alias("partitions"),
    )


def partition_span(orders: DataFrame) -> DataFrame:
    """First, last and number of partitions against the number of dates inside the rows.

    The pairs of both days are few, so they are made distinct first, inside each task.
    """
    own_date = day_text(parse_timestamp(blank_to_null(F.col("order_date")), ORDER_DATE_FORMAT))
    pairs = orders.select(partition_key().alias("part"), own_date.alias("own_date")).distinct()
    return pairs.agg(
        F.countDistinct("part").alias("raw_partitions"),
        F.min("part").alias("min_part"),
        F.max("part").alias("max_part"),
        F.countDistinct("own_date").alias("distinct_order_dates"),
    )


def duplicate_ids(orders: DataFrame, limit: int = 3) -> DataFrame:
    return (
        orders.groupBy("order_id")
        .agg(
            F.count("*").alias("occurrences"),
            F.min("order_date").alias("earliest"),
            F.max("order_date").alias("latest"),
        )
        .where(F.col("occurrences") > 1)
        .orderBy(F.asc_nulls_last("order_id"))
        .limit(limit)
    )


def ids_by_latest_month(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("order_id")
        .agg(F.max("order_date").alias("latest"))
        .groupBy(F.substring("latest", 1, 7).alias("latest_month"))
        .agg(F.count("*").alias("order_ids"))
        .orderBy("latest_month")
    )


def price_profile(products: DataFrame) -> DataFrame:
    return products.agg(
        F.count("*").alias("n"),
        F.round(F.avg("price"), 2).alias("avg_price"),
        F.round(F.sum("price"), 2).alias("total_price"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    union = None
    for name, frame in tables.items():
        counted = frame.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        union = counted if union is None else union.unionByName(counted)
    return union


def customer_preview(customers: DataFrame, limit: int = 2) -> DataFrame:
    return (
        customers.select("customer_id", "customer_name", "country")
        .orderBy("customer_id")
        .limit(limit)
    )


def _per_product(orders: DataFrame) -> DataFrame:
    """Rows and readable units per product, so that a join sees every product once."""
    return orders.groupBy("product_id").agg(
        F.count("*").alias("n"), F.sum(to_int(F.col("quantity"))).alias("units")
    )


def _earned() -> Column:
    return F.round(F.sum(F.col("units") * F.col("price")), 2)


def raw_revenue_by_country(
    orders: DataFrame, customers: DataFrame, products: DataFrame, limit: int = 2
) -> DataFrame:
    """Three raw tables joined, the best countries first.

    Amounts are summed per customer before the customer join: that dimension grows
    with the business and may have a customer with a third of all orders.
    """
    amount = to_int(F.col("quantity")) * F.col("price")
    per_customer = (
        orders.select("customer_id", "product_id", "quantity")
        .join(products.select("product_id", "price"), "product_id")
        .groupBy("customer_id")
        .agg(F.sum(amount).alias("spent"))
    )
    return (
        per_customer.join(customers.select("customer_id", "country"), "customer_id")
        .groupBy("country")
        .agg(F.round(F.sum("spent"), 2).alias("revenue"))
        .orderBy(F.col("revenue").desc(), "country")
        .limit(limit)
    )


def raw_revenue_total(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Quantity times price over orders and products; summed per product before the join."""
    return (
        _per_product(orders)
        .join(products.select("product_id", "price"), "product_id")
        .agg(_earned().alias("revenue"))
    )


def orphan_profile(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Orders without a product: rows and distinct unknown ids; leaked headers do not count."""
    orders = orders.where(F.col("order_id") != "order_id")
    return (
        _per_product(orders)
        .join(products.select("product_id"), "product_id", "left_anti")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
            F.count("product_id").alias("orphan_products"),
        )
    )


def left_join_null_price(orders: DataFrame, products: DataFrame, day: str) -> DataFrame:
    """A left join keeps orphans: rows, revenue and how many rows came without a product."""
    known = products.select(F.col("product_id").alias("_known"), "price")
    orphans = F.sum(F.when(F.col("_known").isNull(), F.col("n")).otherwise(0))
    return (
        _per_product(orders.where(day_partition(day)))
        .join(known, F.col("product_id") == F.col("_known"), "left")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows_kept"),
            _earned().alias("revenue"),
            F.coalesce(orphans, F.lit(0)).alias("null_price_rows"),
        )
    )


def one_day_join_revenue(orders: DataFrame, products: DataFrame, day: str) -> DataFrame:
    """The same day through an inner join: orphans are gone without a trace."""
    return (
        _per_product(orders.where(day_partition(day)))
        .join(products.select("product_id", "price"), "product_id")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows_kept"), _earned().alias("revenue")
        )
    )
