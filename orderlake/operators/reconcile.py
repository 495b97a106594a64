"""Counts of a run and what must hold between them.

Source rows are duplicates, valid or rejected rows; what stays after deduplication is valid or
rejected; what the fact holds of the run afterwards is what was valid. Source and distinct
orders are counted on the delivered ids, valid and rejected rows on the judged table, so a step
that loses a row, or a dimension that repeats a key and multiplies one, breaks the balance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.scalars import blank_to_null
from orderlake.operators.cleanse import REASON


def source_counts(orders: DataFrame) -> DataFrame:
    """(source_rows, deduplicated_rows) from ids alone; a row without id counts for itself."""
    order = blank_to_null(F.col("order_id").cast("string"))
    return orders.agg(
        F.count("*").alias("source_rows"),
        (F.countDistinct(order) + F.count_if(order.isNull())).alias("deduplicated_rows"),
    )


def verdict_counts(annotated: DataFrame) -> DataFrame:
    """(valid_rows, rejected_rows) in one pass."""
    return annotated.agg(
        F.count_if(F.col(REASON).isNull()).alias("valid_rows"),
        F.count_if(F.col(REASON).isNotNull()).alias("rejected_rows"),
    )


def balance(counts: DataFrame) -> DataFrame:
    """Add the identities to rows of the five counts."""
    source, deduplicated, valid, rejected, curated = (
        F.col(f"{name}_rows")
        for name in ("source", "deduplicated", "valid", "rejected", "curated")
    )
    duplicates = source - deduplicated
    accounted: Column = deduplicated == valid + rejected
    written: Column = curated == valid
    return counts.select(
        source.alias("source_rows"),
        duplicates.alias("duplicates_removed"),
        deduplicated.alias("deduplicated_rows"),
        valid.alias("valid_rows"),
        rejected.alias("rejected_rows"),
        curated.alias("curated_rows"),
        accounted.alias("accounted_for"),
        written.alias("curated_matches_valid"),
        (source == duplicates + valid + rejected).alias("every_source_row_explained"),
        (accounted & written).alias("balanced"),
    )


def reconcile(source: DataFrame, annotated: DataFrame, curated: DataFrame) -> DataFrame:
    """The reconciliation record as a one-row DataFrame."""
    spark = source.sparkSession
    counts = spark.range(1).select(
        # One subquery per table: each is scanned once for all of its counts.
        _packed(source_counts(source)).alias("source"),
        _packed(verdict_counts(annotated)).alias("judged"),
        curated.agg(F.count("*")).scalar().alias("curated_rows"),
    )
    return balance(counts.select("source.*", "judged.*", "curated_rows"))


def _packed(one_row: DataFrame) -> Column:
    return one_row.select(F.struct("*")).scalar()
