"""Raw tables by catalog name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orderlake.contract import Contract
from orderlake.sinks.tables import publish_table


def extract(
    spark: SparkSession, database: str, tables: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """customers, products and orders from the catalog, still lazy."""
    named = tables or Contract().tables
    return {name: spark.table(f"{database}.{table}") for name, table in named.items()}


def register_raw_csv(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Declare raw CSV files as an external table.

    The schema is declared because an all-text file gives no hint which line is its
    header; it would come in as data.
    """
    return publish_table(
        spark,
        table,
        path,
        schema,
        partition_by=partition_by,
        fmt="csv",
        options={"header": "true"},
        statistics=None,
    )
