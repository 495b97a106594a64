"""Schema checks on raw text: inference, drift, values that do not fit, leaked headers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions.dates import partition_key
from orderlake.functions.scalars import does_not_fit

# The candidate types of text columns, narrowest first.
INFERENCE_ORDER = ("int", "bigint", "double", "boolean", "date", "timestamp")
# How a truth value or a day is spelled; a cast alone takes more, such as 'y'
# for a truth value and a time of day behind a date.
_SPELLING = {"boolean": r"(?i)^\s*(true|false)\s*$", "date": r"^\s*\d{4}-\d{2}-\d{2}\s*$"}


def source_folder(name: str) -> Column:
    """The value of a ``name=value`` folder in the path of the file a row came from."""
    return F.regexp_extract(F.col("_metadata.file_path"), f"/{name}=([^/]+)/", 1)


def infer_schema(text: DataFrame, by: Column, columns: Sequence[str]) -> DataFrame:
    """Narrowest type that fits every value, per delivery and column.

    All deliveries are inferred in one pass over all rows; a column without any
    value stays string.
    """
    grouped = text.groupBy(by.alias("delivery")).agg(
        *[
            _narrowest(F.col(name)).alias(name)
            for name in columns
        ]
    )
    return grouped.unpivot("delivery", list(columns), "column_name", "inferred_type")


def _narrowest(col: Column) -> Column:
    chain = None
    for candidate in INFERENCE_ORDER:
        misfit = does_not_fit(col, candidate)
        if candidate in _SPELLING:
            misfit = misfit | ~col.rlike(_SPELLING[candidate])
        fits = (F.count(col) > 0) & (F.count_if(misfit) == 0)
        chain = F.when(fits, candidate) if chain is None else chain.when(fits, candidate)
    return chain.otherwise("string")


def schema_drift(text: DataFrame, declared: T.StructType, by: Column) -> DataFrame:
    """Per delivery and typed column: rows, values, and how many do not fit the declaration."""
    typed = [f for f in declared.fields if not isinstance(f.dataType, T.StringType)]
    counted = text.groupBy(by.alias("delivery")).agg(
        F.count("*").alias("rows_seen"),
        F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("declared_type"),
                    F.count(f.name).alias("values_seen"),
                    F.count_if(does_not_fit(F.col(f.name), f.dataType.simpleString())).alias(
                        "misfits"
                    ),
                )
                for f in typed
            ]
        ).alias("columns"),
    )
    return counted.select("delivery", "rows_seen", F.inline("columns"))


def uncastable_values(text: DataFrame, declared: T.StructType) -> DataFrame:
    """Rows whose text does not fit a declared type, one row per offending column."""
    typed = [f for f in declared.fields if not isinstance(f.dataType, T.StringType)]
    keep = [f.name for f in declared.fields if isinstance(f.dataType, T.StringType)]
    findings = F.array(
        *[
            F.when(
                does_not_fit(F.col(f.name), f.dataType.simpleString()),
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    F.col(f.name).alias("raw_value"),
                    F.lit(f.dataType.simpleString()).alias("declared_type"),
                ),
            )
            for f in typed
        ]
    )
    return text.select(*keep, F.inline(F.array_compact(findings)))


def drift_impact(text: DataFrame, column: str) -> DataFrame:
    """The sum of a drifted column, read tolerantly, and what the tolerance costs."""
    value = F.col(column).try_cast("double")
    return text.agg(
        F.count("*").alias("rows_seen"),
        F.round(F.sum(value), 2).alias("total"),
        F.count_if(does_not_fit(F.col(column), "double")).alias("lost_values"),
        F.count_if(F.col(column).isNull()).alias("null_values"),
    )


def header_leak(rows: DataFrame, column: str) -> DataFrame:
    """Header lines that came in as data, next to the size of the table."""
    return rows.agg(
        F.count("*").alias("total_rows"),
        F.countDistinct(column).alias("distinct_ids"),
        F.coalesce(F.sum(F.when(F.col(column) == column, 1).otherwise(0)), F.lit(0)).alias(
            "header_rows"
        ),
    )


def partition_mismatch(orders: DataFrame, ts: Column) -> DataFrame:
    """Rows filed under another day than their own date says, and rows without a readable date."""
    own_day = F.date_format(ts, "yyyy-MM-dd")
    return orders.agg(
        F.count("*").alias("rows_seen"),
        F.count_if(own_day != partition_key()).alias("misfiled_rows"),
        F.count_if(own_day.isNull()).alias("unreadable_dates"),
    )


def _digest(texts: Sequence[str]) -> Column:
    """SHA-256 over text columns: each its length and itself, so that no two rows spell the same."""
    spelled = [
        F.coalesce(F.concat(F.octet_length(name).cast("string"), F.lit(":"), name), F.lit("-"))
        for name in texts
    ]
    return F.unhex(F.sha2(F.concat(*spelled), 256))


def format_equality(encodings: dict[str, DataFrame]) -> DataFrame:
    """Do all encodings hold the same rows? (encoding, rows, rows_not_everywhere).

    All encodings are counted per distinct row in one grouping, so this is exact
    for duplicates too and needs a single shuffle with map-side combination. The
    text columns of a row are one SHA-256 digest in it: nearly every row is a group of its
    own, and a task holds all groups of its input.
    """
    names = list(encodings)
    union = None
    for position, name in enumerate(names):
        rows = encodings[name].select(*encodings[names[0]].columns)
        texts = [f.name for f in rows.schema.fields if f.dataType == T.StringType()]
        tagged = rows.select(
            *[name for name in rows.columns if name not in texts],
            *([_digest(texts).alias("_texts")] if texts else []),
            F.lit(position).alias("_encoding"),
        )
        union = tagged if union is None else union.unionByName(tagged)
    columns = [name for name in union.columns if name != "_encoding"]
    per_row = union.groupBy(*columns).agg(
        *[F.count_if(F.col("_encoding") == i).alias(f"_n{i}") for i in range(len(names))]
    )
    counts = [F.col(f"_n{i}") for i in range(len(names))]
    uneven = F.greatest(*counts) != F.least(*counts)
    summed = per_row.agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("encoding"),
                    F.coalesce(F.sum(counts[i]), F.lit(0)).alias("rows_seen"),
                    F.coalesce(F.sum(F.when(uneven, counts[i]).otherwise(0)), F.lit(0)).alias(
                        "rows_not_everywhere"
                    ),
                )
                for i, name in enumerate(names)
            ]
        ).alias("encodings")
    )
    return summed.select(F.inline("encodings"))
