"""Checks of the pipeline against an independent truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.scalars import to_int
from orderlake.operators.cleanse import REASON


def ground_truth_diff(truth: DataFrame, rejects: DataFrame) -> DataFrame:
    """Planted defects against rejected rows, per defect: expected, actual and the differences.

    Only defects the truth speaks about are compared; a reject for another reason
    is unexpected only if its order was planted with a different defect.
    """
    planted = truth.select("defect", "order_id", F.lit(1).alias("planted"))
    found = rejects.select(
        F.col(REASON).alias("defect"), "order_id", F.lit(1).alias("found")
    ).join(truth.select("defect").distinct(), "defect", "left_semi")
    return (
        planted.join(found, ["defect", "order_id"], "full")
        .groupBy("defect")
        .agg(
            F.count("planted").alias("expected"),
            F.count("found").alias("actual"),
            F.count_if(F.col("found").isNull()).alias("missing"),
            F.count_if(F.col("planted").isNull()).alias("unexpected"),
        )
        .orderBy("defect")
    )


def orphan_policy_compare(orders: DataFrame, products: DataFrame) -> DataFrame:
    """What inner join, left join and an explicit split each keep and report as revenue.

    One left join feeds all three policies: an inner join keeps the matched rows, a
    left join all of them, and the split keeps the matched ones while it sets the
    others aside, counted. Rows are summed per product before the join.
    """
    per_product = orders.groupBy("product_id").agg(
        F.count("*").alias("n"), F.sum(to_int(F.col("quantity"))).alias("units")
    )
    priced = products.select(F.col("product_id").alias("_known"), "price")
    joined = per_product.join(priced, F.col("product_id") == F.col("_known"), "left")
    known = F.col("_known").isNotNull()
    totals = joined.agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("matched"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("all_rows"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("orphans"),
        F.round(F.sum(F.col("units") * F.col("price")), 2).alias("revenue"),
    )
    policies = F.array(
        _policy("inner_join", F.col("matched"), F.lit(0), F.lit(0)),
        _policy("left_join", F.col("all_rows"), F.col("orphans"), F.lit(0)),
        _policy("split", F.col("matched"), F.lit(0), F.col("orphans")),
    )
    return totals.select(F.inline(policies))


def _policy(name: str, kept: Column, unpriced: Column, set_aside: Column) -> Column:
    return F.struct(
        F.lit(name).alias("policy"),
        kept.alias("rows_kept"),
        unpriced.cast("bigint").alias("rows_without_product"),
        set_aside.cast("bigint").alias("rows_set_aside"),
        F.col("revenue"),
    )
