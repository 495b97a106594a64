"""The curated-sales run: judge once, verify, then publish.

Everything a run publishes is derived from one staged table of judged rows. The
stage cuts the lineage: counts, curated and quarantine rows agree even when
executors are lost, and the expensive deduplication is not repeated for each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.contract import Contract
from orderlake.functions.dates import date_parts, partition_key
from orderlake.operators.cleanse import (
    CLEAN_COLUMNS,
    NEWEST_FIRST,
    accepted,
    judge_orders,
    rejected,
    transform,
)
from orderlake.operators.keys import first_per_key
from orderlake.operators.reconcile import balance, reconcile
from orderlake.session import discard, path_exists, settings, shared_folder
from orderlake.sinks.writers import (
    READ_SETTINGS,
    WRITE_SETTINGS,
    gathered,
    write_curated,
    write_quarantine,
)
from orderlake.sources.readers import read_curated


class ReconciliationError(RuntimeError):
    """The counts of a run do not add up; nothing of it was published."""


@dataclass(frozen=True)
class LakePaths:
    """Where a run reads and writes; all of it on storage every executor reaches.

    ``work`` holds tables that only cut lineage. ``redo`` holds merged days until they
    are published and therefore lies with the lake, as safe as the fact itself.
    """

    curated: str
    quarantine: str
    ledger: str
    redo: str
    work: str

    @classmethod
    def below(cls, spark: SparkSession, root: str, contract: Contract | None = None) -> LakePaths:
        names = contract or Contract()
        shared = shared_folder(spark)
        # A name of its own for each lake: two roots that differ in any character never share.
        lake_name = hashlib.sha256(root.encode()).hexdigest()[:32]
        return cls(
            curated=f"{root}/{names.curated_prefix}",
            quarantine=f"{root}/{names.quarantine_prefix}",
            ledger=f"{root}/reconciliation",
            redo=f"{root}/_redo",
            work=f"{shared}/orderlake/{lake_name}" if shared else f"{root}/_work",
        )


# Staged tables are read back once or twice and then go: small files count for more than speed.
STAGE_COMPRESSION = "zstd"


def _complete(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_SUCCESS")


def _stage_once(frame: DataFrame, path: str) -> DataFrame:
    """Write a table unless an earlier attempt of the same run finished it; read it back."""
    spark = frame.sparkSession
    if not _complete(spark, path):
        with settings(spark, WRITE_SETTINGS | READ_SETTINGS):
            frame.write.mode("overwrite").option("compression", STAGE_COMPRESSION).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def zero_record(spark: SparkSession) -> DataFrame:
    """The record of a run without new data, which balances."""
    names = ("source", "deduplicated", "valid", "rejected", "curated")
    zeros = [F.lit(0).cast("bigint").alias(f"{name}_rows") for name in names]
    return balance(spark.range(1).select(*zeros))


def append_record(record: DataFrame, ledger: str, run_id: str) -> None:
    """Add a run to the history; a replay replaces its own record."""
    (
        record.withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(ledger)
    )


def merge_sales(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing and new sales with one row per order: the latest version of each wins.

    Only orders the delivery speaks about compete. The others are told apart by one join
    with the ids of the delivery and pass by without the sort of the competition.
    """
    ids = new.select(F.col("order_id").alias("_named")).distinct()
    marked = existing.join(ids, F.col("order_id") == F.col("_named"), "left")
    untouched = marked.where("_named is null").drop("_named")
    contested = marked.where("_named is not null").drop("_named").unionByName(new)
    return untouched.unionByName(first_per_key(contested, "order_id", NEWEST_FIRST))


def touched_partitions(
    existing: DataFrame, new: DataFrame, partition_by: Sequence[str]
) -> DataFrame:
    """Partitions a merge has to rewrite: those of the new rows, and those the same orders lie in.

    The second part finds orders that move to another day. It reads only the id
    column of the existing fact, and of that only row groups whose id range overlaps
    the delivery's: with ids that grow over time, little of the history.
    """
    bounds = new.agg(F.min("order_id").alias("low"), F.max("order_id").alias("high")).first()
    moved = (
        existing.select("order_id", *partition_by)
        .where(F.col("order_id").between(bounds.low, bounds.high))
        .join(new.select("order_id"), "order_id", "left_semi")
        .select(*partition_by)
    )
    return new.select(*partition_by).unionByName(moved).distinct()


def _drop_partitions(spark: SparkSession, curated: str, names: DataFrame) -> None:
    """Delete day partitions; their number is bounded by the calendar."""
    for row in names.collect():
        discard(spark, "/".join([curated, *[f"{p}={row[p]}" for p in names.columns]]))


def publish_merged(
    spark: SparkSession, new: DataFrame, curated: str, redo: str, contract: Contract
) -> int:
    """Merge new sales into the partitioned fact by rewriting the touched partitions only.

    Returns how many of the new orders the fact holds afterwards, in this or a later version.

    The merged partitions are written beside the fact first and published from
    there. That copy is also the redo log: if the publishing step dies halfway, a
    replay of the run publishes it again and never recomputes it from a
    half-replaced fact.
    """
    parts = contract.partition_by
    if not path_exists(spark, curated):
        write_curated(new, curated, partition_by=parts, compression=contract.compression)
        return read_curated(spark, curated, parts).count()
    existing = read_curated(spark, curated, parts)
    touched = _stage_once(touched_partitions(existing, new, parts), f"{redo}/touched")
    # Names of day partitions: their number is bounded by the calendar, not by the rows.
    names = [row.name for row in touched.select(partition_key(parts).alias("name")).collect()]
    affected = existing.where(partition_key(parts).isin(names))
    merged = _stage_once(merge_sales(affected, new), f"{redo}/merged")
    write_curated(merged, curated, partition_by=parts, compression=contract.compression)
    # A partition whose last order moved away has no row to replace it with.
    emptied = touched.join(merged.select(*parts).distinct(), list(parts), "left_anti")
    _drop_partitions(spark, curated, emptied)
    published = read_curated(spark, curated, parts).where(partition_key(parts).isin(names))
    held = new.join(published.select("order_id"), "order_id", "left_semi").count()
    discard(spark, redo)
    return held


def publish_full(
    spark: SparkSession,
    sales: DataFrame,
    curated: str,
    contract: Contract,
    by_day: DataFrame | None = None,
) -> int:
    """Replace the whole fact; returns how many rows it holds afterwards.

    ``by_day`` are the same sales with the rows of a day brought together. Days of an earlier run that this one has no order for go once the new days are there: an
    order that moved to another day is in the fact once.
    """
    parts = contract.partition_by
    if not path_exists(spark, curated) and sales.isEmpty():
        return 0
    write_curated(
        sales if by_day is None else by_day,
        curated,
        partition_by=parts,
        compression=contract.compression,
        together=by_day is not None,
    )
    published = read_curated(spark, curated, parts)
    days = published.select(*parts).distinct()
    stale = days.join(sales.select(*parts).distinct(), list(parts), "left_anti")
    _drop_partitions(spark, curated, stale)
    return read_curated(spark, curated, parts).count()


def run_curated_sales(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    paths: LakePaths,
    run_id: str,
    *,
    contract: Contract | None = None,
    merge: bool = False,
    landed: bool = False,
) -> dict[str, object]:
    """One run: deduplicate, clean, judge, reconcile, publish. Returns the reconciliation record.

    ``merge=False`` takes ``orders`` as all there is and replaces the whole fact.
    ``merge=True`` adds the delivery to what is already there. ``run_id`` identifies the run on
    replay: the same id publishes the same rows once. The source is read once, into the work
    folder, or is a table already written for this run (``landed=True``); a run that lost or multiplied rows publishes nothing, and the record counts what
    the fact really holds of the run after publishing.
    """
    rules = contract or Contract()
    spark = orders.sparkSession
    if not orders.columns:
        record = zero_record(spark)
        append_record(record, paths.ledger, run_id)
        return record.first().asDict()

    work = f"{paths.work}/{run_id}"
    source = orders.select(*CLEAN_COLUMNS)
    if not landed:
        source = _stage_once(source, f"{work}/source")
    annotated = judge_orders(
        source,
        customers,
        products,
        statuses=rules.valid_statuses,
        date_format=rules.order_date_format,
        whole_rows=True,
    )
    # Neither fact nor quarantine takes these from the verdicts, so no join has to move them.
    judged = _stage_once(annotated.drop("created_date", "order_total"), f"{work}/judged")
    sales = transform(accepted(judged), partition_by=rules.partition_by)
    expected = reconcile(source, judged, sales)
    with settings(spark, READ_SETTINGS):
        counts = expected.first().asDict()
    if not counts["balanced"]:
        # The next attempt must judge again, for example with repaired dimensions.
        discard(spark, work)
        raise ReconciliationError(f"reconciliation did not balance, nothing published: {counts}")

    if counts["rejected_rows"]:
        write_quarantine(rejected(judged), paths.quarantine, run_id)
    else:
        # Rejects of an earlier attempt, which this one has no rows to replace with.
        discard(spark, f"{paths.quarantine}/run_id={run_id}")
    if not merge:
        # What is derived from other columns need not be shuffled with them.
        parts = rules.partition_by
        day = F.concat_ws("-", *date_parts(F.col("order_date"), parts))
        by_day = gathered(accepted(judged).withColumn("_day", day), "_day")
        held = publish_full(
            spark, sales, paths.curated, rules, transform(by_day, partition_by=parts)
        )
    elif counts["valid_rows"]:
        held = publish_merged(spark, sales, paths.curated, f"{paths.redo}/{run_id}", rules)
    else:
        held = 0
    names = ("source", "deduplicated", "valid", "rejected")
    known = [F.lit(counts[f"{n}_rows"]).cast("bigint").alias(f"{n}_rows") for n in names]
    record = balance(spark.range(1).select(*known, F.lit(held).cast("bigint").alias("curated_rows")))
    report = record.first().asDict()
    append_record(record, paths.ledger, run_id)
    if not report["balanced"]:
        raise ReconciliationError(f"the fact does not hold what was valid: {report}")
    discard(spark, work)
    return report
