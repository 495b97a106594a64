"""From raw orders to the sales fact: deduplicate, clean, judge, enrich, derive.

A row is never dropped silently. Every deduplicated row gets a verdict: NULL
means valid, anything else is the one reason it goes to quarantine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.contract import ORDER_DATE_FORMAT, PARTITION_COLUMNS, VALID_STATUSES
from orderlake.functions.dates import date_parts
from orderlake.functions.scalars import blank_to_null, money, parse_timestamp, to_int
from orderlake.functions.texts import packed, unpacked
from orderlake.operators.keys import first_per_key
from orderlake.schemas import CURATED, QUARANTINE, RAW_ORDERS

REASON = "rejection_reason"
CLEAN_COLUMNS = tuple(RAW_ORDERS.fieldNames())
# Which version of an order wins.
NEWEST_FIRST = {"order_date": "desc", "status": "asc"}


def deduplicate(orders: DataFrame) -> DataFrame:
    """One row per order: the latest date, then the lower status, then the other columns.

    Ids are compared without the blanks around them. A row without an id is nobody's
    version: all of them stay, apart from the competition, and go to quarantine later.
    """
    keyed = orders.withColumn("_order", blank_to_null(F.col("order_id").cast("string")))
    latest = first_per_key(keyed.where(F.col("_order").isNotNull()), "_order", NEWEST_FIRST)
    return latest.unionByName(keyed.where(F.col("_order").isNull())).drop("_order")


def clean(
    orders: DataFrame, *, date_format: str = ORDER_DATE_FORMAT, keep_raw: bool = False
) -> DataFrame:
    """Normalise and type the order columns; what cannot be read becomes NULL.

    With ``keep_raw`` the original text of date and quantity travels along, so a
    quarantined row still shows what was wrong with it.
    """
    text = {
        field.name: blank_to_null(F.col(field.name))
        if field.dataType.typeName() == "string"
        else F.col(field.name)
        for field in orders.schema.fields
    }
    typed = {
        **{name: text[name] for name in ("order_id", "customer_id", "product_id")},
        "quantity": to_int(text["quantity"]),
        "order_date": parse_timestamp(text["order_date"], date_format),
        "status": F.upper(text["status"]),
    }
    if keep_raw:
        typed["raw_order_date"] = F.col("order_date").cast("string")
        typed["raw_quantity"] = F.col("quantity").cast("string")
    return orders.select(*[column.alias(name) for name, column in typed.items()])


def rejection_rules(statuses: Sequence[str] = VALID_STATUSES) -> list[tuple[str, Column]]:
    """Reason and condition, most important first; a row is given the first that holds.

    Unknown keys are looked at before prices, which only a known product can have.
    """
    known_status = F.coalesce(F.col("status").isin(*statuses), F.lit(False))
    # The names of the reasons and their order.
    return [
        ("null_order_id", F.col("order_id").isNull()),
        ("null_customer_id", F.col("customer_id").isNull()),
        ("malformed_order_date", F.col("order_date").isNull()),
        ("non_numeric_quantity", F.col("quantity").isNull()),
        ("non_positive_quantity", F.col("quantity") <= 0),
        ("invalid_order_status", ~known_status),
        ("orphan_customer_id", F.col("_known_customer").isNull()),
        ("orphan_product_id", F.col("_known_product").isNull()),
        ("non_positive_price", F.col("price") <= 0),
        ("non_numeric_price", F.col("price").isNull() | F.isnan("price")),
        ("order_total_out_of_range", F.col("order_total").isNull()),
    ]


def annotate(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    *,
    statuses: Sequence[str] = VALID_STATUSES,
    whole_rows: bool = False,
) -> DataFrame:
    """Cleaned orders with dimension attributes, order_total and rejection_reason.

    Each dimension is joined once, for the verdict and the enrichment together.
    There is no broadcast hint: Spark broadcasts a side it knows or measures to be
    below ``autoBroadcastJoinThreshold`` and otherwise runs a sort-merge join whose
    hot keys AQE splits (a left join may split its left side). ``distinct`` makes
    exact copies of a dimension row harmless; conflicting ones multiply orders and
    are what the reconciliation refuses. Who wants ``whole_rows`` has their texts go through the
    joins as one; else what is not wanted of them stays out.
    """
    keys = ("customer_id", "product_id")
    rows = packed(orders, *keys) if whole_rows else orders
    known_customers = customers.select(
        F.col("customer_id").alias("_known_customer"), "country", "created_date"
    ).distinct()
    known_products = products.select(
        F.col("product_id").alias("_known_product"), "product_name", "category", "price"
    ).distinct()
    # The id that was found says no more than that one was: only that goes through the next join.
    found = F.when(F.col("_known_customer").isNotNull(), True)
    joined = (
        rows.join(known_customers, F.col("customer_id") == F.col("_known_customer"), "left")
        .withColumn("_known_customer", found)
        .join(known_products, F.col("product_id") == F.col("_known_product"), "left")
    )
    if whole_rows:
        joined = unpacked(joined, orders.schema, *keys)
    priced = joined.withColumn("order_total", money(F.col("quantity") * F.col("price")))
    verdict = F.coalesce(
        *[F.when(broken, F.lit(reason)) for reason, broken in rejection_rules(statuses)]
    )
    return priced.withColumn(REASON, verdict).drop("_known_customer", "_known_product")


def accepted(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.col(REASON).isNull())


def rejected(annotated: DataFrame) -> DataFrame:
    """Rejected rows in the quarantine layout."""
    present = [name for name in QUARANTINE.fieldNames() if name in annotated.columns]
    return annotated.where(F.col(REASON).isNotNull()).select(*present)


def validate(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    *,
    statuses: Sequence[str] = VALID_STATUSES,
) -> tuple[DataFrame, DataFrame]:
    """Split cleaned orders into (valid, rejected with reason); nothing is dropped."""
    judged = annotate(orders, customers, products, statuses=statuses)
    return accepted(judged).select(*CLEAN_COLUMNS), rejected(judged)


def enrich(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Attach country, created_date, product_name, category and price to valid orders.

    For orders judged elsewhere; ``annotate`` joins the same attributes for the verdict, so a
    job takes them from there. Exact copies of a dimension row do no harm.
    """
    countries = customers.select("customer_id", "country", "created_date").distinct()
    catalogue = products.select("product_id", "product_name", "category", "price").distinct()
    return orders.join(countries, "customer_id").join(catalogue, "product_id")


def transform(
    enriched: DataFrame, *, partition_by: Sequence[str] = PARTITION_COLUMNS
) -> DataFrame:
    """Order total, partition columns and the fixed column order of the sales fact."""
    totals = enriched.withColumn("order_total", money(F.col("quantity") * F.col("price")))
    facts = [name for name in CURATED.fieldNames() if name not in PARTITION_COLUMNS]
    return totals.select(*facts, *date_parts(F.col("order_date"), partition_by))


def judge_orders(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    *,
    statuses: Sequence[str] = VALID_STATUSES,
    date_format: str = ORDER_DATE_FORMAT,
    whole_rows: bool = False,
) -> DataFrame:
    """Raw orders to annotated orders: deduplicate, clean and judge in one plan."""
    latest = deduplicate(orders.select(*CLEAN_COLUMNS))
    tidy = clean(latest, date_format=date_format, keep_raw=True)
    # Text that the typed value gives back need not travel through the joins.
    again = {
        "raw_order_date": F.date_format("order_date", date_format),
        "raw_quantity": F.col("quantity").cast("string"),
    }
    spared = {name: F.nullif(F.col(name), text) for name, text in again.items()}
    judged = annotate(
        tidy.withColumns(spared), customers, products, statuses=statuses, whole_rows=whole_rows
    )
    return judged.withColumns({name: F.coalesce(name, text) for name, text in again.items()})


def curated_sales(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    *,
    statuses: Sequence[str] = VALID_STATUSES,
) -> DataFrame:
    """The sales fact of one delivery, as a single lazy plan."""
    return transform(accepted(judge_orders(orders, customers, products, statuses=statuses)))


def rejections_by_reason(quarantine: DataFrame) -> DataFrame:
    return (
        quarantine.groupBy(REASON)
        .agg(F.count("*").alias("rows_rejected"))
        .orderBy(F.col("rows_rejected").desc(), REASON)
    )
