"""Storage-layout jobs: daily against hourly, few against many files, compaction, statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.contract import PARTITION_COLUMNS
from orderlake.sinks.writers import TREE_COMPRESSION, write_partitioned

HOURLY = (*PARTITION_COLUMNS, "hour")


def write_daily_and_hourly(
    orders: DataFrame,
    root: str,
    hour: Column,
    *,
    sort_by: Sequence[str] = (),
    arranged: bool = False,
) -> dict[str, str]:
    """The same rows in day and in hour directories; ``orders`` carries year to day as text.

    One shuffle brings the rows of a day together; those of its hours are written from the day
    tree. ``arranged`` orders are read from a tree of days and need no shuffle at all.
    """
    paths = {"daily": f"{root}/daily", "hourly": f"{root}/hourly"}
    compression = TREE_COMPRESSION["parquet"]
    write_partitioned(
        orders, paths["daily"], sort_by=sort_by, compression=compression, arranged=arranged
    )
    days = orders.sparkSession.read.schema(orders.schema).parquet(paths["daily"])
    write_partitioned(
        days.withColumn("hour", hour),
        paths["hourly"],
        partition_by=HOURLY,
        compression=compression,
        arranged=True,
    )
    return paths


def write_file_counts(orders: DataFrame, root: str, files: int = 200) -> dict[str, str]:
    """The same rows as few files of a healthy size (one, if they fit) and as ``files`` small ones."""
    paths = {"one_file": f"{root}/one_file", "many_files": f"{root}/many_files"}
    orders.hint("rebalance").write.mode("overwrite").parquet(paths["one_file"])
    orders.repartition(files).write.mode("overwrite").parquet(paths["many_files"])
    return paths


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    *,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Rewrite a tree of small files as right-sized files per partition, rows unchanged.

    The target is another directory, so a lost job leaves the source whole.
    """
    rows = spark.read.schema(schema).parquet(source)
    write_partitioned(rows, target, partition_by=partition_by, sort_by=sort_by)
    return spark.read.schema(schema).parquet(target)


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, bytes) of every data file below a folder, from the listing alone.

    A file without rows, such as a CSV file with nothing but its header, is there too.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.col("path").alias("file_path"), F.col("length").alias("bytes"))
    )


def layout_stats(datasets: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per dataset (its rows, and the folder they lie in): files, partitions, rows, bytes and
    mean file size.

    Files come from a listing, rows from a scan without columns, which reads Parquet footers only.
    """
    folder = F.regexp_extract("file_path", r"^(.*)/[^/]*$", 1)
    per_dataset = []
    for name, (frame, path) in datasets.items():
        per_dataset.append(
            listed_files(frame.sparkSession, path)
            .agg(
                F.count("*").alias("files"),
                F.countDistinct(folder).alias("partitions"),
                F.sum("bytes").alias("bytes"),
                F.round(F.sum("bytes") / 1048576, 3).alias("megabytes"),
                F.round(F.avg("bytes") / 1024, 2).alias("mean_file_kb"),
            )
            .select(
                F.lit(name).alias("dataset"), "*", frame.agg(F.count("*")).scalar().alias("rows")
            )
        )
    union = per_dataset[0]
    for more in per_dataset[1:]:
        union = union.unionByName(more)
    return union
