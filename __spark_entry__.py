"""

Queries only wire library functions to the lake of a data directory. Results leave
with money as double and timestamps and dates as text, so that two engines can be
compared by value.
"""

from __future__ import annotations

import importlib
import sys
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle_statements
from orderlake import schemas
from orderlake.contract import ORDER_DATE_FORMAT, PARTITION_COLUMNS
from orderlake.functions.dates import day_partition
from orderlake.functions.measures import order_count, revenue, units
from orderlake.functions.scalars import blank_to_null, parse_timestamp, to_int
from orderlake.operators import audit, cleanse, keys, quality, reconcile, schema_checks
from orderlake.operators.governance import governed_view
from orderlake.plans import analytics, raw, star
from orderlake.plans.job import LakePaths, run_curated_sales
from orderlake.plans.lake import PARTITIONED, Lake, lake
from orderlake.session import scratch
from orderlake.sinks import layout, tables, writers
from orderlake.sources import admission, catalog, readers
from orderlake.sources.feed import feed_products_text, feed_truth

DAY = oracle_statements.DAY
Query = Callable[[Lake], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function name (without the underscore that keeps it apart
    from a library function or module of the same name)."""
    _REGISTRY[build.__name__.rstrip("_")] = build
    return build


def _comparable(frame: DataFrame) -> DataFrame:
    def column(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return col.cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(col, "yyyy-MM-dd").alias(field.name)
        return col

    return frame.select(*[column(field) for field in frame.schema.fields])


def _tagged(frames: dict[str, DataFrame], column: str) -> DataFrame:
    tagged = [frame.select(F.lit(tag).alias(column), "*") for tag, frame in frames.items()]
    return reduce(DataFrame.unionByName, tagged)


def _typed(orders: DataFrame) -> DataFrame:
    return orders.withColumn("quantity", to_int(F.col("quantity")))




# ---------------------------------------------------------------- scans


@query
def scan_csv(lk: Lake) -> DataFrame:
    return readers.scan_csv(lk.spark, lk.raw_file("orders"), schemas.TYPED_ORDERS)


@query
def scan_json(lk: Lake) -> DataFrame:
    return readers.scan_json(lk.spark, lk.one_format("json"), schemas.RAW_ORDERS_PARTITIONED)


@query
def scan_parquet(lk: Lake) -> DataFrame:
    return readers.scan_parquet(lk.spark, lk.one_format("parquet_flat"))


@query
def scan_partitioned(lk: Lake) -> DataFrame:
    return readers.scan_partitioned(lk.spark, lk.one_format("parquet"))


@query
def extract(lk: Lake) -> DataFrame:
    """Three raw CSV tables, declared in the catalog and read by name."""
    spark = lk.spark
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS orderlake_raw LOCATION '{scratch(spark, 'database')}'"
    )
    catalog.register_raw_csv(
        spark, "orderlake_raw.customers_raw", lk.raw_file("customers"), schemas.RAW_CUSTOMERS
    )
    catalog.register_raw_csv(
        spark, "orderlake_raw.products_raw", lk.raw_file("products"), schemas.RAW_PRODUCTS
    )
    catalog.register_raw_csv(
        spark,
        "orderlake_raw.orders_raw",
        lk.one_format("csv"),
        schemas.RAW_ORDERS_PARTITIONED,
        partition_by=("year", "month", "day"),
    )
    found = catalog.extract(spark, "orderlake_raw")
    key = {"customers": "customer_id", "products": "product_id", "orders": "order_id"}
    return _tagged(
        {
            name: frame.agg(
                F.count("*").alias("n"), F.countDistinct(key[name]).alias("distinct_keys")
            )
            for name, frame in found.items()
        },
        "table_name",
    )


@query
def incremental_orders(lk: Lake) -> DataFrame:
    """Three deliveries arrive one after the other; the last is late for nearly every day."""
    paths, handled = lk.run_deliveries()
    if handled[-1] != 0:
        raise AssertionError(f"the run without new files read rows: {handled}")
    return readers.read_curated(lk.spark, paths.curated).drop("year", "month", "day")


@query
def admit_files(lk: Lake) -> DataFrame:
    """Order files amid files that must not be read: outside the prefix, not CSV, empty."""
    spark, root = lk.spark, scratch(lk.spark, "arrivals")
    arrived, landed = lk.feed.orders.select(*cleanse.CLEAN_COLUMNS, "delivery"), scratch(spark, "landed")
    arrived.write.parquet(landed)
    delivered = spark.read.schema(arrived.schema).parquet(landed)
    delivered.write.partitionBy("delivery").option("header", True).csv(f"{root}/raw/orders")
    plain = delivered.drop("delivery")
    plain.write.option("header", True).csv(f"{root}/curated/orders/delivery=8")
    plain.write.option("compression", "gzip").json(f"{root}/raw/orders/delivery=9")
    spark.range(0).write.csv(f"{root}/raw/orders/delivery=7")
    rows = admission.read_admitted(spark, root, schemas.RAW_ORDERS, "raw/orders/")
    return rows.groupBy(schema_checks.source_folder("delivery").alias("delivery")).agg(
        F.count("*").alias("rows_admitted")
    )


@query
def stage_sales(lk: Lake) -> DataFrame:
    return readers.stage_sales(lk.spark, lk.published.curated)


# ---------------------------------------------------------------- sinks


@query
def write_curated(lk: Lake) -> DataFrame:
    """Write all days, then one day again: it is replaced, the others stay."""
    path = scratch(lk.spark, "curated")
    writers.write_curated(lk.sales_plan, path)
    writers.write_curated(lk.sales.where(day_partition(DAY)), path)
    return readers.read_curated(lk.spark, path)


@query
def write_quarantine(lk: Lake) -> DataFrame:
    """Two runs, the first replayed: every reject is there once."""
    path = scratch(lk.spark, "quarantine")
    rejects = lk.quarantine.drop("run_id")
    orphans = F.col(cleanse.REASON).startswith("orphan")
    for run_id, part in (("1", ~orphans), ("2", orphans), ("1", ~orphans)):
        writers.write_quarantine(rejects.where(part), path, run_id)
    return lk.spark.read.schema(schemas.QUARANTINE_RUNS).parquet(path).drop("run_id")


@query
def write_formats(lk: Lake) -> DataFrame:
    frames = _read_formats(lk)
    return _tagged(
        {
            name: _typed(frame)
            .groupBy("year", "month", "day")
            .agg(F.count("*").alias("rows_written"), units())
            for name, frame in frames.items()
        },
        "encoding",
    )


def _read_formats(lk: Lake) -> dict[str, DataFrame]:
    frames = {
        fmt: readers.scan_partitioned(lk.spark, lk.formats[fmt], fmt)
        for fmt in ("csv", "json", "parquet")
    }
    frames["parquet_flat"] = readers.scan_parquet(lk.spark, lk.formats["parquet_flat"])
    return frames


def _summary(lk: Lake) -> DataFrame:
    return tables.materialise(
        analytics.category_country_summary(lk.sales),
        "sales_by_category_ctas",
        scratch(lk.spark, "summary"),
    )


@query
def ctas_category_country(lk: Lake) -> DataFrame:
    return _summary(lk)


@query
def ctas_read_back(lk: Lake) -> DataFrame:
    return analytics.summary_by_category(_summary(lk))


@query
def publish_table(lk: Lake) -> DataFrame:
    published = tables.publish_table(
        lk.spark,
        "curated_sales",
        lk.published.curated,
        schemas.CURATED,
        partition_by=("year", "month", "day"),
    )
    return published.groupBy("year", "month", "day").agg(order_count(), revenue())


@query
def publish_star(lk: Lake) -> DataFrame:
    """Rows of the four star tables as the catalog serves them."""
    lk.star  # noqa: B018 - written before it is declared
    published = star.publish_star(lk.spark, lk.star_root, "orderlake_star")
    return _tagged(
        {name: getattr(published, name).agg(F.count("*").alias("n")) for name in star.TABLES},
        "table_name",
    )


@query
def union_deliveries(lk: Lake) -> DataFrame:
    parts = [
        readers.scan_csv(lk.spark, path, schemas.RAW_ORDERS) for path in lk.order_deliveries
    ]
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- predicates, projections


@query
def single_column_projection(lk: Lake) -> DataFrame:
    return analytics.single_column_projection(lk.sales)


@query
def many_column_projection(lk: Lake) -> DataFrame:
    return analytics.many_column_projection(lk.sales)


@query
def pruned_single_day(lk: Lake) -> DataFrame:
    return analytics.pruned_single_day(lk.sales, DAY)


@query
def full_scan_same_answer(lk: Lake) -> DataFrame:
    return analytics.full_scan_same_answer(lk.sales, DAY)


@query
def range_predicate_day(lk: Lake) -> DataFrame:
    return star.range_predicate_day(lk.star, DAY)


@query
def wrapped_predicate_day(lk: Lake) -> DataFrame:
    return star.wrapped_predicate_day(lk.star, DAY)


@query
def governed_view_(lk: Lake) -> DataFrame:
    return governed_view(lk.feed.customers, ["customer_id", "country"], "customers_marketing")


# ---------------------------------------------------------------- cleansing


@query
def deduplicate(lk: Lake) -> DataFrame:
    return cleanse.deduplicate(lk.feed.orders.select(*cleanse.CLEAN_COLUMNS))


@query
def clean(lk: Lake) -> DataFrame:
    return cleanse.clean(deduplicate(lk))


@query
def validate_valid(lk: Lake) -> DataFrame:
    return cleanse.validate(clean(lk), lk.feed.customers, lk.feed.products)[0]


@query
def validate_rejected(lk: Lake) -> DataFrame:
    return cleanse.validate(clean(lk), lk.feed.customers, lk.feed.products)[1]


@query
def enrich(lk: Lake) -> DataFrame:
    return cleanse.enrich(validate_valid(lk), lk.feed.customers, lk.feed.products)


@query
def curated_sales(lk: Lake) -> DataFrame:
    return lk.sales_plan


@query
def reconcile_(lk: Lake) -> DataFrame:
    orders = lk.landed_orders
    judged = cleanse.judge_orders(orders, lk.feed.customers, lk.feed.products)
    return reconcile.reconcile(orders, judged, lk.sales)


@query
def quarantine_by_reason(lk: Lake) -> DataFrame:
    return cleanse.rejections_by_reason(lk.quarantine)


@query
def dimension_key_violations(lk: Lake) -> DataFrame:
    return keys.key_violations(
        {
            "customers": (lk.feed.customers, "customer_id"),
            "products": (lk.feed.products, "product_id"),
            "orders": (lk.feed.orders, "order_id"),
        }
    )


@query
def ground_truth_diff(lk: Lake) -> DataFrame:
    return audit.ground_truth_diff(feed_truth(lk.spark, lk.root), lk.quarantine)


@query
def orphan_policy_compare(lk: Lake) -> DataFrame:
    return audit.orphan_policy_compare(_orders_raw(lk).where(day_partition(DAY)), lk.feed.products)


# ---------------------------------------------------------------- analytics on the fact


@query
def revenue_by_category(lk: Lake) -> DataFrame:
    return analytics.revenue_by_category(lk.sales)


@query
def top_customers_by_country(lk: Lake) -> DataFrame:
    return analytics.top_customers_by_country(lk.sales)


@query
def join_curated_to_raw_customers(lk: Lake) -> DataFrame:
    customers = readers.scan_csv(lk.spark, lk.raw_file("customers"), schemas.RAW_CUSTOMERS)
    return analytics.buyers_by_country(lk.sales, customers)


# ---------------------------------------------------------------- raw tables


def _orders_raw(lk: Lake) -> DataFrame:
    return readers.scan_partitioned(lk.spark, lk.one_format("csv"), "csv")


def _bench_orders(lk: Lake) -> DataFrame:
    return _typed(readers.scan_partitioned(lk.spark, lk.one_format("parquet")))


@query
def status_totals(lk: Lake) -> DataFrame:
    return raw.status_totals(_bench_orders(lk))


@query
def status_totals_one_day(lk: Lake) -> DataFrame:
    return raw.status_totals_one_day(_bench_orders(lk), DAY)


@query
def units_total(lk: Lake) -> DataFrame:
    return raw.units_total(_bench_orders(lk))


@query
def raw_profile(lk: Lake) -> DataFrame:
    return raw.raw_profile(_orders_raw(lk))


@query
def partition_span(lk: Lake) -> DataFrame:
    return raw.partition_span(_orders_raw(lk))


@query
def duplicate_ids(lk: Lake) -> DataFrame:
    return raw.duplicate_ids(_orders_raw(lk))


@query
def ids_by_latest_month(lk: Lake) -> DataFrame:
    return raw.ids_by_latest_month(_orders_raw(lk))


@query
def price_profile(lk: Lake) -> DataFrame:
    return raw.price_profile(lk.feed.products)


@query
def table_counts(lk: Lake) -> DataFrame:
    return raw.table_counts(
        {
            "customers": lk.feed.customers,
            "products": lk.feed.products,
            "orders": _orders_raw(lk),
        }
    )


@query
def customer_preview(lk: Lake) -> DataFrame:
    return raw.customer_preview(lk.feed.customers)


@query
def raw_revenue_by_country(lk: Lake) -> DataFrame:
    return raw.raw_revenue_by_country(_orders_raw(lk), lk.feed.customers, lk.feed.products)


@query
def raw_revenue_total(lk: Lake) -> DataFrame:
    return raw.raw_revenue_total(_orders_raw(lk), lk.feed.products)


@query
def orphan_profile(lk: Lake) -> DataFrame:
    return raw.orphan_profile(_orders_raw(lk), lk.feed.products)


@query
def left_join_null_price(lk: Lake) -> DataFrame:
    return raw.left_join_null_price(_orders_raw(lk), lk.feed.products, DAY)


@query
def one_day_join_revenue(lk: Lake) -> DataFrame:
    return raw.one_day_join_revenue(_orders_raw(lk), lk.feed.products, DAY)


# ---------------------------------------------------------------- star schema


@query
def dim_customer(lk: Lake) -> DataFrame:
    return star.dim_customer(lk.sales)


@query
def dim_product(lk: Lake) -> DataFrame:
    return star.dim_product(lk.sales)


@query
def dim_date(lk: Lake) -> DataFrame:
    return star.dim_date(star.fact_orders(lk.sales))


@query
def fact_orders(lk: Lake) -> DataFrame:
    return star.fact_orders(lk.sales)


@query
def revenue_by_country(lk: Lake) -> DataFrame:
    return star.revenue_by_country(lk.star)


@query
def star_revenue_by_category(lk: Lake) -> DataFrame:
    return star.revenue_by_category(lk.star)


@query
def monthly_revenue_trend(lk: Lake) -> DataFrame:
    return star.monthly_revenue_trend(lk.star)


@query
def star_join_all_dimensions(lk: Lake) -> DataFrame:
    return star.star_join_all_dimensions(lk.star)


@query
def reconcile_fact(lk: Lake) -> DataFrame:
    return star.reconcile_fact(lk.star)


@query
def reconcile_dims(lk: Lake) -> DataFrame:
    return star.reconcile_dims(lk.star)


@query
def raw_vs_fact(lk: Lake) -> DataFrame:
    return star.raw_vs_fact(_orders_raw(lk), lk.star)


@query
def key_skew(lk: Lake) -> DataFrame:
    return keys.key_skew(lk.star.fact_orders, "customer_id")


# ---------------------------------------------------------------- quality, schema


def _dq_tables(lk: Lake):
    orders = _orders_raw(lk)
    blanked = orders.select(
        *[
            blank_to_null(F.col(name)).alias(name)
            for name in ("order_id", "customer_id", "quantity")
        ]
    )
    return {
        "orders": (blanked, quality.ORDERS_RULES),
        "products": (lk.feed.products, quality.PRODUCTS_RULES),
    }


@query
def dq_results(lk: Lake) -> DataFrame:
    return quality.dq_results(_dq_tables(lk))


@query
def dq_uniqueness(lk: Lake) -> DataFrame:
    return quality.uniqueness(_orders_raw(lk), "order_id")


@query
def dq_score(lk: Lake) -> DataFrame:
    return quality.dq_score(dq_results(lk))


@query
def infer_schema(lk: Lake) -> DataFrame:
    """Types of all three raw tables, per delivery; customers come in one."""
    once = lk.feed.customers.withColumn("delivery", F.lit("1"))
    orders = lk.feed.orders.withColumn("delivery", F.col("delivery").cast("string"))
    found = {
        "products": schema_checks.infer_schema(
            lk.read_product_deliveries(),
            schema_checks.source_folder("delivery"),
            schemas.RAW_PRODUCTS_TEXT.fieldNames(),
        ),
        "customers": schema_checks.infer_schema(
            once, F.col("delivery"), schemas.RAW_CUSTOMERS.fieldNames()
        ),
        "orders": schema_checks.infer_schema(
            orders, F.col("delivery"), list(cleanse.CLEAN_COLUMNS)
        ),
    }
    return _tagged(found, "table_name")


@query
def schema_drift(lk: Lake) -> DataFrame:
    return schema_checks.schema_drift(
        lk.read_product_deliveries(),
        schemas.RAW_PRODUCTS,
        schema_checks.source_folder("delivery"),
    )


@query
def uncastable_values(lk: Lake) -> DataFrame:
    return schema_checks.uncastable_values(
        feed_products_text(lk.spark, lk.root), schemas.RAW_PRODUCTS
    )


@query
def header_leak(lk: Lake) -> DataFrame:
    """One header line more in every day's file, as a file glued to another brings it in."""
    spark, path = lk.spark, scratch(lk.spark, "glued")
    names = [F.lit(name).alias(name) for name in cleanse.CLEAN_COLUMNS]
    headers = lk.raw_orders.select(*names, *PARTITION_COLUMNS).distinct()
    writers.write_partitioned(lk.raw_orders.unionByName(headers), path, fmt="csv")
    return schema_checks.header_leak(readers.scan_partitioned(spark, path, "csv"), "order_id")


@query
def drift_impact(lk: Lake) -> DataFrame:
    return schema_checks.drift_impact(feed_products_text(lk.spark, lk.root), "price")


@query
def partition_mismatch(lk: Lake) -> DataFrame:
    """Orders of every tenth customer are filed a year early."""
    path = scratch(lk.spark, "misfiled")
    moved = F.when(F.col("customer_id").endswith("7"), "2025").otherwise(F.col("year"))
    writers.write_partitioned(lk.raw_orders.withColumn("year", moved), path)
    filed = readers.scan_partitioned(lk.spark, path)
    written = parse_timestamp(blank_to_null(F.col("order_date")), ORDER_DATE_FORMAT)
    return schema_checks.partition_mismatch(filed, written)


@query
def format_equality(lk: Lake) -> DataFrame:
    """The four encodings, of which JSON lost its returns and altered pending quantities."""
    encodings = _read_formats(lk)
    altered = F.when(F.col("status") == "PENDING", F.concat("quantity", F.lit("0")))
    encodings["json"] = (
        encodings["json"]
        .where(~F.col("status").eqNullSafe("RETURNED"))
        .withColumn("quantity", F.coalesce(altered, "quantity"))
    )
    return schema_checks.format_equality(encodings)


# ---------------------------------------------------------------- storage layout


HOURLY_SCHEMA = T.StructType(
    [*schemas.RAW_ORDERS_PARTITIONED.fields, T.StructField("hour", T.StringType())]
)


def _layouts(lk: Lake) -> dict[str, DataFrame]:
    paths = lk.layouts
    return {
        "daily": readers.scan_partitioned(lk.spark, paths["daily"]),
        "hourly": readers.scan_partitioned(lk.spark, paths["hourly"], schema=HOURLY_SCHEMA),
    }


@query
def layout_daily_hourly(lk: Lake) -> DataFrame:
    return _tagged(
        {
            name: _typed(frame)
            .groupBy("year", "month", "day")
            .agg(F.count("*").alias("orders"), units())
            for name, frame in _layouts(lk).items()
        },
        "layout",
    )


@query
def layout_file_count(lk: Lake) -> DataFrame:
    day = lk.raw_orders.where(day_partition(DAY))
    paths = layout.write_file_counts(day, scratch(lk.spark, "file-counts"))
    return _tagged(
        {
            name: raw.status_totals(_typed(lk.spark.read.parquet(path)))
            for name, path in paths.items()
        },
        "layout",
    )


@query
def layout_stats(lk: Lake) -> DataFrame:
    """Partitions and rows of every layout and encoding, and whether there is a file for each.

    Numbers and sizes of files, which the operator reports too, depend on the writer.
    """
    paths = lk.stored
    frames = {**_read_formats(lk), **_layouts(lk), "curated": lk.sales}
    stats = layout.layout_stats({name: (frames[name], paths[name]) for name in frames})
    filed = ((F.col("files") >= F.col("partitions")) & (F.col("bytes") > 0)).alias("filed")
    return stats.select("dataset", "partitions", "rows", filed)


@query
def full_rebuild(lk: Lake) -> DataFrame:
    """The fact after two full runs; in the first, a third of the orders lay a year earlier."""
    paths = LakePaths.below(lk.spark, scratch(lk.spark, "rebuilt"))
    landed = lk.landed_orders
    late = landed.withColumn(
        "order_date",
        F.when(F.col("delivery") == 3, F.regexp_replace("order_date", "2026", "2025")).otherwise(
            F.col("order_date")
        ),
    )
    for run_id, orders in (("first", late), ("second", landed)):
        run_curated_sales(
            orders.select(*cleanse.CLEAN_COLUMNS),
            lk.feed.customers,
            lk.feed.products,
            paths,
            run_id,
        )
    return readers.read_curated(lk.spark, paths.curated)


@query
def run_history(lk: Lake) -> DataFrame:
    """The ledger of the three deliveries, one record per run that had new files."""
    paths, _ = lk.run_deliveries()
    number = F.regexp_extract("run_id", "([0-9]+)$", 1).cast("int") + 1
    counts = ("source", "deduplicated", "valid", "rejected", "curated")
    return lk.spark.read.parquet(paths.ledger).select(
        number.alias("delivery"), *[f"{name}_rows" for name in counts], "balanced"
    )


@query
def compact(lk: Lake) -> DataFrame:
    """The hour tree of small files rewritten as a day tree."""
    target = scratch(lk.spark, "compacted")
    compacted = layout.compact(lk.spark, lk.layouts["hourly"], target, HOURLY_SCHEMA)
    return compacted.select(*PARTITIONED)


# ---------------------------------------------------------------- contract functions


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: revenue by category over the sales fact, as one plan from the raw tables."""
    return _comparable(
        analytics.revenue_by_category(lake(spark, "/root/testdata/sf0.001").sales_plan)
    )


def _runner(build: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _comparable(build(lake(spark, sf_dir)))


def _installed(module: str):
    """A module of the text operators, or None where they are not installed."""
    try:
        return importlib.import_module(module)
    except ModuleNotFoundError as error:
        if not (error.name or "").startswith(("corpus_pipeline", "orderlake.llm")):
            raise
        return None


def _corpus() -> tuple[dict, dict]:
    """Queries and twins of the text operators and of the pipeline over them."""
    found, twins = {}, {}
    if operators := _installed("orderlake.llm.queries"):
        found, twins = operators.queries(), operators.oracle_sql()
    if pipeline := _installed("corpus_pipeline"):
        found["pipeline"] = pipeline.run
        if pipeline.ORACLE_SQL:
            twins["pipeline"] = pipeline.ORACLE_SQL
    return found, twins


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(build) for name, build in _REGISTRY.items()} | _corpus()[0]


def oracle_sql() -> dict[str, str]:
    return oracle_statements.statements() | _corpus()[1]
