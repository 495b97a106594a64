"""Raw and curated readers. Schemas are declared; a scan never infers one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orderlake.contract import PARTITION_COLUMNS
from orderlake.schemas import CURATED_FILE, RAW_ORDERS_PARTITIONED


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    header: bool = True,
    recursive: bool = False,
) -> DataFrame:
    """CSV with a header line per file. A value that does not fit its type becomes NULL.

    ``recursive`` reads all folders below ``path`` and ignores what they are named after.
    """
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", True)
        .option("recursiveFileLookup", recursive)
        .csv(path)
    )


def scan_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON Lines."""
    return spark.read.schema(schema).json(path)


def scan_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def scan_partitioned(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType = RAW_ORDERS_PARTITIONED,
) -> DataFrame:
    """A year=/month=/day= tree. The declared schema keeps partition values text ('08')."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def read_curated(
    spark: SparkSession, path: str, partition_by: Sequence[str] = PARTITION_COLUMNS
) -> DataFrame:
    parts = [T.StructField(name, T.StringType()) for name in partition_by]
    return scan_partitioned(spark, path, schema=T.StructType([*CURATED_FILE.fields, *parts]))


def stage_sales(spark: SparkSession, path: str) -> DataFrame:
    """Curated rows for the star load: the 11 file columns, in the types the files really have.

    The landing schema mirrors the files (price double, order_total decimal). A
    different file is refused here instead of being cast or shifted silently.
    """
    landed = spark.read.parquet(path).select(*CURATED_FILE.fieldNames())
    found = [(f.name, f.dataType) for f in landed.schema]
    declared = [(f.name, f.dataType) for f in CURATED_FILE]
    if found != declared:
        wrong = [f"{d[0]}: {f[1]} is not {d[1]}" for f, d in zip(found, declared) if f != d]
        raise TypeError(f"curated files do not match the landing schema: {wrong}")
    return landed
