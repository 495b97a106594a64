"""Which arrived files may be read: below the prefix, named *.csv and not empty, all at once.

Joining the three conditions with AND matters: with OR the job would admit the
files it writes itself and trigger its own next run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def folder_of(spark: SparkSession, root: str, prefix: str) -> str:
    """The folder ``prefix`` below the lake root, as Spark names the files in it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{prefix.strip('/')}")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return f"{store.makeQualified(path).toString()}/"


def admissible(path: Column, size: Column, folder: str, suffix: str = ".csv") -> Column:
    """``folder`` is the full name of the folder, not a part that may stand anywhere in a path."""
    return path.startswith(folder) & path.endswith(suffix) & (size > 0)


def arrivals(
    spark: SparkSession, root: str, prefix: str, suffix: str = ".csv"
) -> DataFrame:
    """Every file below ``root`` with its verdict: (path, size, admitted).

    Only names and sizes are listed; the content column is pruned away.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", F.col("length").alias("size"))
    )
    return listed.withColumn(
        "admitted",
        admissible(F.col("path"), F.col("size"), folder_of(spark, root, prefix), suffix),
    )


def read_admitted(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    prefix: str,
    suffix: str = ".csv",
) -> DataFrame:
    """Rows of the admitted files; folders outside the prefix are not even listed."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .csv(folder_of(spark, root, prefix))
        .where(F.col("_metadata.file_size") > 0)
    )
