"""The star schema: derived from the curated fact, loaded as pure functions, then queried."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions.dates import day_range, day_text
from orderlake.functions.measures import order_count, revenue
from orderlake.functions.scalars import mean_money, money
from orderlake.sinks.tables import publish_table


def dim_customer(sales: DataFrame) -> DataFrame:
    """Customers that bought something."""
    return sales.groupBy("customer_id").agg(F.max("country").alias("country"))


def dim_product(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_id").agg(
        F.max("product_name").alias("product_name"),
        F.max("category").alias("category"),
        money(F.max("price")).alias("price"),
    )


def dim_date(facts: DataFrame) -> DataFrame:
    """The days that occur in the fact; gaps are not filled."""
    date = F.col("date_key")
    return (
        facts.select(F.to_date("order_date").alias("date_key"))
        .distinct()
        .select(
            date,
            F.year(date).cast("smallint").alias("year"),
            F.month(date).cast("smallint").alias("month"),
            F.dayofmonth(date).cast("smallint").alias("day"),
            F.date_format(date, "EEEE").alias("day_name"),
            # Spark counts days of the week from Sunday = 1.
            F.dayofweek(date).isin(1, 7).alias("is_weekend"),
        )
    )


def fact_orders(sales: DataFrame) -> DataFrame:
    """Keys and measures only, price narrowed to money."""
    return sales.select(
        "order_id", "customer_id", "product_id", "order_date", "quantity",
        money(F.col("price")).alias("price"), "order_total", "status",
    )


@dataclass(frozen=True)
class Star:
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    fact_orders: DataFrame


TABLES = tuple(Star.__dataclass_fields__)


def derive_star(sales: DataFrame) -> Star:
    """All four tables as lazy plans over the curated fact."""
    facts = fact_orders(sales)
    return Star(dim_customer(sales), dim_product(sales), dim_date(facts), facts)


def write_star(sales: DataFrame, root: str, ranges: int | None = None) -> None:
    """Load the star, replacing an earlier load (a second run does not double it).

    The fact is range-partitioned and sorted by time, so a dated predicate skips
    files and row groups by min/max; ``order_id`` in the range key keeps a single
    busy moment from landing in one task. ``ranges`` is the number of ranges and so of
    files, at most ``spark.sql.shuffle.partitions`` (small ones merged) if not given; for a
    large fact ask for its size divided by 256 MB.
    """
    star = derive_star(sales)
    keys = ("order_date", "order_id")
    facts = star.fact_orders.repartitionByRange(*([ranges] if ranges else []), *keys)
    for name in ("dim_customer", "dim_product", "dim_date"):
        dimension = getattr(star, name)
        _load(dimension.sortWithinPartitions(dimension.columns[0]), f"{root}/{name}")
    _load(facts.sortWithinPartitions("order_date", "order_id"), f"{root}/fact_orders")


def _load(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("compression", "zstd").parquet(path)


def publish_star(spark: SparkSession, root: str, database: str) -> Star:
    """Declare a written star as catalog tables with column statistics and read it from there.

    The statistics give the optimizer the size of every join side, also after filters.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    published = [
        publish_table(spark, f"{database}.{name}", path, spark.read.parquet(path).schema)
        for name, path in ((name, f"{root}/{name}") for name in TABLES)
    ]
    return Star(*published)


def read_star(spark: SparkSession, root: str) -> Star:
    return Star(*[spark.read.parquet(f"{root}/{name}") for name in TABLES])


def _by_attribute(facts: DataFrame, dim: DataFrame, key: str, *attributes: str) -> DataFrame:
    """Fact totals by attributes of one dimension (and, if named, of the fact).

    The fact is summed per key before the join: map-side combination leaves one row per
    key and task to shuffle, and a hot key is a single row by the time it is joined. How the
    join runs is Spark's choice.
    """
    named = dim.select(key, *[name for name in attributes if name in dim.columns])
    measures = (order_count(), revenue(), F.count("order_total").alias("priced"))
    own = [name for name in attributes if name not in dim.columns]
    per_key = facts.groupBy(key, *own).agg(*measures)
    sums = [F.sum(name).alias(name) for name in ("orders", "revenue", "priced")]
    return per_key.join(named, key).groupBy(*attributes).agg(*sums)


def revenue_by_country(star: Star) -> DataFrame:
    totals = _by_attribute(star.fact_orders, star.dim_customer, "customer_id", "country")
    return totals.select("country", "revenue").orderBy(F.col("revenue").desc(), "country")


def revenue_by_category(star: Star) -> DataFrame:
    totals = _by_attribute(star.fact_orders, star.dim_product, "product_id", "category")
    return totals.select(
        "category",
        "orders",
        "revenue",
        mean_money(F.col("revenue"), F.col("priced")).alias("avg_order"),
    ).orderBy(F.col("revenue").desc(), "category")


def monthly_revenue_trend(star: Star) -> DataFrame:
    """By calendar month, through the date dimension; the fact is summed per day first."""
    per_day = star.fact_orders.groupBy(F.to_date("order_date").alias("date_key")).agg(
        order_count(), revenue()
    )
    return (
        per_day.join(star.dim_date.select("date_key", "year", "month"), "date_key")
        .groupBy("year", "month")
        .agg(F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))
        .orderBy("year", "month")
    )


def star_join_all_dimensions(star: Star, limit: int = 20) -> DataFrame:
    """Revenue by category, country and month over all dimensions, highest first.

    The fact is summed per customer, product and day before any dimension is joined. The
    grouping keys close the sort order, so the cut at ``limit`` is stable.
    """
    day = F.to_date("order_date").alias("date_key")
    per_key = star.fact_orders.groupBy("customer_id", "product_id", day).agg(
        order_count(), revenue()
    )
    keys = ["category", "country", "year", "month"]
    totals = (
        per_key.join(star.dim_date.select("date_key", "year", "month"), "date_key")
        .join(star.dim_product.select("product_id", "category"), "product_id")
        .join(star.dim_customer.select("customer_id", "country"), "customer_id")
        .groupBy(*keys)
        .agg(F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))
    )
    return (
        totals.select(*keys, "orders", "revenue")
        .orderBy(F.col("revenue").desc(), *keys)
        .limit(limit)
    )


def _day_totals(facts: DataFrame, predicate: Column) -> DataFrame:
    return facts.where(predicate).agg(order_count(), revenue())


def range_predicate_day(star: Star, day: str) -> DataFrame:
    """One day as a range on the sort column, which Parquet statistics can serve."""
    return _day_totals(star.fact_orders, day_range(F.col("order_date"), day))


def wrapped_predicate_day(star: Star, day: str) -> DataFrame:
    """The same day with the column wrapped in a function, kept for comparison."""
    return _day_totals(star.fact_orders, day_text(F.col("order_date")) == day)


def reconcile_fact(star: Star) -> DataFrame:
    """Rows, distinct orders and revenue of the loaded fact, to hold against its source."""
    return star.fact_orders.agg(
        F.count("*").alias("fact_rows"),
        F.countDistinct("order_id").alias("distinct_orders"),
        revenue(),
    )


def _row_count(frame: DataFrame) -> Column:
    return frame.agg(F.count("*")).scalar()


def reconcile_dims(star: Star) -> DataFrame:
    spark = star.fact_orders.sparkSession
    return spark.range(1).select(
        _row_count(star.dim_customer).alias("customers"),
        _row_count(star.dim_product).alias("products"),
        _row_count(star.dim_date).alias("dates"),
    )


def raw_vs_fact(raw_orders: DataFrame, star: Star) -> DataFrame:
    """Raw rows next to fact rows; the difference is duplicates and rejects."""
    return raw_orders.sparkSession.range(1).select(
        _row_count(raw_orders).alias("raw_order_rows"),
        _row_count(star.fact_orders).alias("fact_order_rows"),
    )
