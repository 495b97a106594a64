"""Sinks. Every partitioned write is rebalanced by its partition columns first, unless its rows
are read from files that hold one partition, or a few of them, each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.contract import PARTITION_COLUMNS
from orderlake.functions.texts import packed, unpacked
from orderlake.session import settings

# Shuffle files go when the write they served is done. Otherwise they stay until the driver
# happens to collect its garbage, and those of one write after the other fill the disks.
WRITE_SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# Compressed rows unfold to 20 times and more: what sorts, counts or holds them in a task reads
# no more than this of them, or it would spill.
READ_SETTINGS = {"spark.sql.files.maxPartitionBytes": "32MB"}

# A tree written from another one: a task reads a few of its files and keeps a writer open for
# each of their partitions, so that nothing is sorted (past the limit Spark sorts the rest).
TREE_SETTINGS = READ_SETTINGS | {"spark.sql.maxConcurrentOutputFileWriters": "128"}

# Encodings and layouts of the raw orders: the same rows several times, so size counts.
TREE_COMPRESSION = {"csv": "gzip", "json": "gzip", "parquet": "zstd"}


def _arranged(
    frame: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str], together: bool
) -> DataFrame:
    """Bring the rows of a partition together in files of a healthy size.

    REBALANCE lets AQE merge small partitions and split a day that holds most of
    the data over several tasks, where ``repartition`` would give it one. The
    local sort keeps one writer open per task and gives row groups tight
    min/max statistics.
    """
    rows = frame if together else gathered(frame, *partition_by)
    return rows.sortWithinPartitions(*partition_by, *sort_by)


def gathered(frame: DataFrame, *keys: str) -> DataFrame:
    """Rows of the same keys brought together, in partitions of a healthy size."""
    return unpacked(packed(frame, *keys).hint("rebalance", *keys), frame.schema, *keys)


def write_partitioned(
    frame: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
    sort_by: Sequence[str] = (),
    fmt: str = "parquet",
    compression: str | None = None,
    together: bool = False,
    arranged: bool = False,
) -> None:
    """Replace exactly the partitions present in ``frame``; all others stay.

    ``together`` says that the plan of ``frame`` has brought the rows of a partition together,
    with ``gathered``; they are only sorted. ``arranged`` says that ``frame`` reads a tree of the same partitions or coarser ones, whose
    files have a healthy size: its rows are together already and go without shuffle and sort.
    """
    writer = (
        (frame if arranged else _arranged(frame, partition_by, sort_by, together))
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
    )
    if compression:
        writer = writer.option("compression", compression)
    for key, value in TEXT_OPTIONS.get(fmt, {}).items():
        writer = writer.option(key, value)
    with settings(frame.sparkSession, WRITE_SETTINGS | (TREE_SETTINGS if arranged else {})):
        writer.save(path)


# A raw layer keeps what was sent: a header line, and blanks around values. JSON names every
# column in every row, so its files are compressed.
TEXT_OPTIONS = {
    "json": {"compression": "gzip"},
    "csv": {
        "header": "true",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
}


def write_curated(
    sales: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
    compression: str = "snappy",
    together: bool = False,
) -> None:
    """The sales fact, partitioned by day and sorted by time inside each file.

    The rows of a day are ``together`` already if ``gathered`` stands below the plan of the sales.
    """
    write_partitioned(
        sales,
        path,
        partition_by=partition_by,
        sort_by=["order_date"],
        compression=compression,
        together=together,
    )


def write_quarantine(rejects: DataFrame, path: str, run_id: str) -> None:
    """Add a run's rejects. A replay of the run replaces its own rows and no others.

    There is no date partition: a row rejected for its date has none. The few rejects
    of many tasks are brought together, so that a run does not leave a file per task.
    """
    (
        gathered(rejects)
        .withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("run_id")
        .parquet(path)
    )


def write_flat(
    frame: DataFrame, path: str, *, fmt: str = "parquet", compression: str | None = None
) -> None:
    """The same rows without a directory tree; partition values stay ordinary columns."""
    writer = frame.write.format(fmt).mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    for key, value in TEXT_OPTIONS.get(fmt, {}).items():
        writer = writer.option(key, value)
    with settings(frame.sparkSession, WRITE_SETTINGS):
        writer.save(path)


FORMATS = ("csv", "json", "parquet", "parquet_flat")


def write_formats(
    orders: DataFrame,
    root: str,
    names: Sequence[str] = FORMATS,
    *,
    sort_by: Sequence[str] = (),
    arranged: bool = False,
) -> dict[str, str]:
    """Orders as partitioned CSV, JSON Lines and Parquet, and as flat Parquet; of these, ``names``.

    The plan behind ``orders`` runs once: for the flat copy, where that is asked for, from which
    the trees are written; else for the only tree. ``arranged`` orders are read from a tree of
    the same days and need no copy.
    """
    paths = {name: f"{root}/{name}/orders" for name in names}
    trees = [name for name in names if name != "parquet_flat"]
    landed = orders
    if "parquet_flat" in names or (len(trees) > 1 and not arranged):
        flat = paths.get("parquet_flat", f"{root}/parquet_flat/orders")
        write_flat(orders, flat, compression=TREE_COMPRESSION["parquet"])
        if not arranged:
            landed = orders.sparkSession.read.schema(orders.schema).parquet(flat)
    for name in trees:
        write_partitioned(
            landed,
            paths[name],
            sort_by=sort_by,
            fmt=name,
            compression=TREE_COMPRESSION[name],
            arranged=arranged,
        )
    return paths
