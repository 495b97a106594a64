"""Date helpers that keep predicates prunable."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zero-padded text, as in the partition paths.
PART_PATTERNS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}


def date_part_text(ts: Column, part: str) -> Column:
    return F.date_format(ts, PART_PATTERNS[part]).alias(part)


def date_parts(ts: Column, parts: Sequence[str] = ("year", "month", "day")) -> list[Column]:
    return [date_part_text(ts, part) for part in parts]


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def day_range(ts: Column, day: str) -> Column:
    """One day as a half-open range on the bare column.

    Unlike ``date_format(ts, ...) = day`` it reaches the Parquet reader, where
    row groups are skipped by their min/max statistics.
    """
    start = dt.date.fromisoformat(day)
    end = start + dt.timedelta(days=1)
    return (ts >= F.lit(start).cast("timestamp")) & (ts < F.lit(end).cast("timestamp"))


def day_partition(day: str) -> Column:
    """The same day as a predicate on the partition columns, resolved without reading a file."""
    year, month, number = day.split("-")
    return (
        (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == number)
    )


def days_between(ts: Column, first: str, last: str) -> Column:
    """All days from ``first`` to ``last``, inclusive, on a table partitioned by day.

    Spark does not derive a partition filter from a time filter, so both are given:
    the partition predicate skips directories, the range skips row groups.
    """
    start = F.lit(dt.date.fromisoformat(first)).cast("timestamp")
    end = F.lit(dt.date.fromisoformat(last) + dt.timedelta(days=1)).cast("timestamp")
    return partition_key().between(first, last) & (ts >= start) & (ts < end)


def partition_key(parts: Sequence[str] = ("year", "month", "day")) -> Column:
    return F.concat_ws("-", *[F.col(part) for part in parts])
