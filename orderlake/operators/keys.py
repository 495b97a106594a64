"""Operators on keys: one row per key, broken keys, key distribution."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


SLICES = 16


def first_per_key(frame: DataFrame, key: str, preference: Mapping[str, str]) -> DataFrame:
    """Keep the most preferred row of every key.

    ``preference`` maps columns to "asc" or "desc", most important first, NULL
    always last. All other columns complete it, so the order is total and the
    winner does not depend on partitioning. A ``row_number`` filtered to its first
    place lets Spark limit each key inside every map task before the shuffle: a key
    with a third of all rows still sends one row per task.
    """
    directions = {
        **preference,
        **{name: "asc" for name in frame.columns if name not in (key, *preference)},
    }
    order = [
        F.desc_nulls_last(name) if direction == "desc" else F.asc_nulls_last(name)
        for name, direction in directions.items()
    ]
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return frame.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def key_violations(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Declared keys that occur more than once: (table_name, key_value, occurrences)."""
    found = [
        frame.groupBy(F.col(key).alias("key_value"))
        .agg(F.count("*").alias("occurrences"))
        .where(F.col("occurrences") > 1)
        .select(F.lit(name).alias("table_name"), "key_value", "occurrences")
        for name, (frame, key) in tables.items()
    ]
    union = found[0]
    for more in found[1:]:
        union = union.unionByName(more)
    return union


def key_skew(frame: DataFrame, key: str) -> DataFrame:
    """How evenly a hash of the key spreads rows over 16 slices.

    ``slices`` counts those with rows. With an empty slice the quietest has 0 rows and the skew,
    busiest over quietest, has no bound: NULL.
    """
    slices = frame.groupBy(F.substring(F.md5(F.col(key)), 1, 1).alias("slice")).agg(
        F.count("*").alias("n")
    )
    empty = F.count("*") < SLICES
    return slices.agg(
        F.count("*").alias("slices"),
        F.max("n").alias("busiest_rows"),
        F.when(empty, 0).otherwise(F.min("n")).alias("quietest_rows"),
        F.when(~empty, F.round(F.max("n") / F.min("n"), 4)).alias("skew"),
    )
