"""Incremental orders: a file stream that handles what arrived since the last run and stops.

The checkpoint remembers which files were read. A run without new files succeeds
without calling the batch step. Dimensions are read in full for every batch:
reading only their new rows would turn every order into an orphan.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.contract import Contract
from orderlake.plans.job import STAGE_COMPRESSION, LakePaths, run_curated_sales
from orderlake.schemas import RAW_ORDERS

# More days than have passed since 1970: an archive restored with a zero date is still read.
MAX_FILE_AGE = "100000d"
Dimension = Callable[[SparkSession], DataFrame]


def arriving_orders(
    spark: SparkSession,
    source: str,
    max_files_per_trigger: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Order files below ``source``: only ``*.csv`` and only files with content.

    Every run lists ``source`` and the stream remembers each file it has read. With
    ``archive``, a folder outside ``source``, files that were handled move there, so that
    neither the listing nor the memory grows with the history.
    """
    reader = (
        spark.readStream.schema(RAW_ORDERS)
        .option("header", True)
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        # By default a file a week older than the newest one seen is skipped silently.
        .option("maxFileAge", MAX_FILE_AGE)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(source).where(F.col("_metadata.file_size") > 0)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the stream when its checkpoint was made."""
    stored = spark.read.text(f"{checkpoint}/metadata", wholetext=True).first().value
    return json.loads(stored)["id"]


def run_incremental(
    spark: SparkSession,
    source: str,
    customers: Dimension,
    products: Dimension,
    paths: LakePaths,
    checkpoint: str,
    *,
    name: str = "orders",
    contract: Contract | None = None,
    max_files_per_trigger: int | None = None,
    archive: str | None = None,
) -> int:
    """Process the new files and return how many rows they held.

    Each micro-batch is landed once as Parquet, so the text is parsed a single
    time and all later steps run as ordinary adaptive batch jobs. The run id is made of the
    stream's own id and the batch number: a replayed batch publishes nothing twice, and a
    second stream on the same lake replaces nothing of the first.
    """

    handled: list[int] = []

    def step(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{name}-{_stream_id(spark, checkpoint)}-{batch_id:09d}"
        landed = f"{paths.work}/{run_id}/landed"
        batch.write.mode("overwrite").option("compression", STAGE_COMPRESSION).parquet(landed)
        report = run_curated_sales(
            spark.read.schema(RAW_ORDERS).parquet(landed),
            customers(spark),
            products(spark),
            paths,
            run_id,
            contract=contract,
            merge=True,
            landed=True,
        )
        handled.append(report["source_rows"])

    query = (
        arriving_orders(spark, source, max_files_per_trigger, archive)
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(handled)
