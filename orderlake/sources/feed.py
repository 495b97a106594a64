"""The order feed as views over the supplied tables.

``lineitem`` joined to ``orders`` is the order feed: (l_orderkey, l_linenumber)
repeats with different contents, so it carries real conflicting duplicates.
Ship dates are folded into a 42-day window, which keeps days as full as a real
feed's. Defects are planted by ``l_orderkey`` so that every copy of an order
shares its defect; prices are broken by ``p_partkey``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions.dates import date_parts

# Fixed values of the feed, shared with the checking SQL.
FIRST_DAY = "2026-07-09"
DAYS = 42
BUCKETS = 100
DEFECT_BUCKETS = {
    0: "null_customer_id",
    1: "malformed_order_date",
    2: "non_numeric_quantity",
    3: "non_positive_quantity",
    4: "invalid_order_status",
    5: "orphan_customer_id",
    6: "orphan_product_id",
}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def _padded(prefix: str, key: str, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(key).cast("string"), width, "0"))


def _pick(bucket: Column, planted: dict[int, Column], usual: Column) -> Column:
    """The planted value of this row's bucket, or the usual one."""
    chosen = usual
    for number, value in planted.items():
        chosen = F.when(bucket == number, value).otherwise(chosen)
    return chosen


def feed_orders(spark: SparkSession, root: str) -> DataFrame:
    """Raw orders, all text, with the delivery day as year/month/day and the delivery number."""
    # Only what the feed needs of a column goes through the shuffle of the join: the day in the
    # window (DAYS where there is none) and two truth values in one number.
    day = F.pmod(F.unix_date(F.to_date("l_shipdate")), F.lit(DAYS))
    returned = F.when(F.col("l_returnflag") == "R", 2).otherwise(0)
    finished = F.when(F.col("l_linestatus") == "F", 1).otherwise(0)
    lines = table(spark, root, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.coalesce(day, F.lit(DAYS)) * 4 + returned + finished).alias("state"),
        (F.col("l_suppkey") % 10 == 0).alias("late"),
    )
    heads = table(spark, root, "orders").select(
        "o_orderkey", "o_custkey", (F.col("o_orderstatus") == "P").alias("pending")
    )
    # Both sides grow with the data: always a sort-merge join, which also spreads the
    # single row group of the small test files over all cores.
    joined = lines.join(heads.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))

    bucket = F.col("l_orderkey") % BUCKETS
    line = F.col("l_linenumber")
    order_id = F.concat(_padded("O", "l_orderkey", 12), F.lit("-"), line.cast("string"))
    state = F.col("state")
    offset = F.when(F.shiftright(state, 2) != DAYS, F.shiftright(state, 2))
    delivered = F.date_add(F.lit(FIRST_DAY).cast("date"), offset)
    hour = F.lpad((F.col("l_orderkey") % 24).cast("string"), 2, "0")
    stamp = F.concat(F.date_format(delivered, "yyyy-MM-dd"), F.lit(" "), hour, F.lit(":30:00"))
    malformed = (
        F.when(line % 3 == 0, F.date_format(delivered, "dd/MM/yyyy"))
        .when(line % 3 == 1, F.date_format(delivered, "yyyy-MM-dd"))
        .otherwise(F.lit("2026-02-30 10:00:00"))
    )
    quantity = F.col("quantity").cast("string")
    status = (
        F.when(F.col("l_orderkey") % 17 == 5, "CANCELLED")
        .when(state.bitwiseAND(2) != 0, "RETURNED")
        .when(F.col("pending"), "PENDING")
        .when(state.bitwiseAND(1) != 0, "DELIVERED")
        .otherwise("SHIPPED")
    )
    spelled = (
        F.when(line == 3, F.lower(status))
        .when(line == 5, F.concat(F.lit(" "), status, F.lit(" ")))
        .otherwise(status)
    )
    return joined.select(
        F.when(F.col("l_orderkey") % 1000 != 107, order_id).alias("order_id"),
        _pick(
            bucket,
            {
                0: F.lit("  "),
                5: F.concat(F.lit("C-MISSING-"), (F.col("o_custkey") % 3).cast("string")),
            },
            _padded("C", "o_custkey", 9),
        ).alias("customer_id"),
        _pick(
            bucket,
            {6: F.concat(F.lit("P-MISSING-"), (F.col("l_partkey") % 3).cast("string"))},
            _padded("P", "l_partkey", 9),
        ).alias("product_id"),
        _pick(
            bucket,
            {2: F.lit("abc"), 3: F.concat(F.lit("-"), quantity)},
            F.when(line == 6, F.concat(F.lit(" "), quantity)).otherwise(quantity),
        ).alias("quantity"),
        _pick(bucket, {1: malformed}, stamp).alias("order_date"),
        _pick(bucket, {4: F.when(line != 1, F.lit("LOST"))}, spelled).alias("status"),
        *date_parts(delivered),
        # Every tenth supplier reports late; the others in two half windows.
        F.when(F.col("late"), 3)
        .when(offset < DAYS // 2, 1)
        .otherwise(2)
        .alias("delivery"),
    )


def feed_customers(spark: SparkSession, root: str) -> DataFrame:
    customers = table(spark, root, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, root, "nation").select("n_nationkey", "n_name")
    days = (F.col("c_custkey") % 2000).cast("int")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        _padded("C", "c_custkey", 9).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lower(F.translate("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("country"),
        F.date_format(F.date_add(F.lit("2015-01-01").cast("date"), days), "yyyy-MM-dd").alias(
            "created_date"
        ),
    )


def feed_products(spark: SparkSession, root: str) -> DataFrame:
    slot = F.col("p_partkey") % 211
    price = (
        F.when(slot == 17, -F.col("p_retailprice"))
        .when(slot == 23, F.lit(0.0))
        .when(slot != 29, F.col("p_retailprice"))
    )
    return table(spark, root, "part").select(
        _padded("P", "p_partkey", 9).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        price.alias("price"),
    )


def feed_products_text(spark: SparkSession, root: str) -> DataFrame:
    """Products as a drifting source sends them: price is text and sometimes a word.

    Deliveries 1 to 3 by product key; only delivery 3 holds the bad token.
    """
    key = F.substring("product_id", 2, 9).cast("long")
    delivery = (key % 3 + 1).cast("int")
    return feed_products(spark, root).select(
        "product_id",
        "product_name",
        "category",
        F.when((delivery == 3) & (key % 5 == 0), F.lit("UNKNOWN"))
        .otherwise(F.col("price").cast("string"))
        .alias("price"),
        delivery.alias("delivery"),
    )


def feed_truth(spark: SparkSession, root: str) -> DataFrame:
    """What was planted: (defect, order_id), one row per damaged order."""
    lines = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber")
    bucket = F.col("l_orderkey") % BUCKETS
    defect = F.coalesce(*[F.when(bucket == n, F.lit(r)) for n, r in DEFECT_BUCKETS.items()])
    order_id = F.concat(
        _padded("O", "l_orderkey", 12), F.lit("-"), F.col("l_linenumber").cast("string")
    )
    return (
        lines.select(defect.alias("defect"), order_id.alias("order_id"))
        .where(F.col("defect").isNotNull())
        .distinct()
    )


@dataclass(frozen=True)
class Feed:
    """The three raw tables of one data directory."""

    orders: DataFrame
    customers: DataFrame
    products: DataFrame

    @classmethod
    def of(cls, spark: SparkSession, root: str) -> Feed:
        return cls(
            feed_orders(spark, root), feed_customers(spark, root), feed_products(spark, root)
        )
