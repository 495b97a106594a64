"""Helpers the operators share: words, Arrow maps, links into components.

Texts are handled as UTF-8 bytes where that makes no difference: lower-casing the letters A-Z
is ``bytes.lower`` and splitting at the six ASCII white-space characters is ``bytes.split``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.session import scratch

# Byte table for words of letters, digits and everything beyond ASCII: A-Z to a-z, any other
# ASCII byte that is no letter or digit to a space.
_WORD_TABLE = bytes(
    b + 32
    if 65 <= b <= 90
    else (b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32)
    for b in range(256)
)


_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FILE_ROWS = 1 << 16  # of a narrow table whose size is known: fewer files than its shuffle has parts


def plain_words(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII characters."""
    return text.translate(_WORD_TABLE).split()


def texts_of(batch: pa.RecordBatch, column: str) -> Iterator[bytes | None]:
    """The texts of a batch as bytes, one at a time (a batch is never unpacked whole)."""
    for value in batch.column(column).cast(pa.large_binary()):
        yield value.as_py()


def map_rows(
    frame: DataFrame, schema: str, columns: list[str], row: Callable, setup: Callable | None = None
) -> DataFrame:
    """One result row per input row: ``row(state, *values)`` returns the tuple of new columns.

    ``columns`` are the input columns handed over; the last one is the text and comes as bytes.
    ``setup`` builds the state once per task. Results leave in small batches.
    """
    arrow_schema = frame.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(arrow_schema)
        state = setup() if setup else None
        for batch in batches:
            others = [batch.column(c).to_pylist() for c in columns[:-1]]
            rows = [
                row(state, *values, text)
                for *values, text in zip(*others, texts_of(batch, columns[-1]), strict=True)
            ]
            arrays = [
                pa.array([r[i] for r in rows], type=field.type) for i, field in enumerate(target)
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return frame.select(*columns).mapInArrow(run, schema)


def crc_bucket(column: str, modulus: int):
    """crc32 of the id's decimal text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame below the shared folder and read it back.

    Cuts the lineage: later jobs read files that survive the loss of an executor.
    """
    spark = frame.sparkSession
    path = scratch(spark, label)
    before = spark.conf.get(_CLEAN_UP)
    spark.conf.set(_CLEAN_UP, "true")  # the shuffles of this write are of no use after it
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(frame.schema).parquet(path)


def in_parts(frame: DataFrame, rows: int) -> DataFrame:
    """``frame``, a few numbers a row and about ``rows`` of them, in no more parts than that takes.

    A table of a few thousand rows in hundreds of files costs more than its rows do: a local file
    system without Hadoop's native library starts three processes for each file. Parts are only
    put together, so a large table stays as its shuffle has dealt it.
    """
    return frame.coalesce(max(1, -(-rows // _FILE_ROWS)))


def _fingerprint(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(child, root))")).first()
    return tuple(row)


def connected(links: DataFrame, rows: int | None = None) -> DataFrame:
    """Components of an undirected graph: (node, root) with root the smallest reachable node.

    ``links`` has two columns ``a`` and ``b`` of one orderable type. Alternating large-star and
    small-star rounds (Kiveris et al., 2014) rewire every node to the smallest neighbour it
    knows; a round is two aggregations with map-side combination and two joins whose hot side
    AQE can split. Rounds are written to the shared folder, in as many files as their links take,
    and end when nothing changes.
    Nodes without a link do not appear; nulls and self-links are ignored; an empty input gives
    an empty result. ``rows``: how many rows ``links`` has, if that is known.
    """
    current = (
        links.where("a != b")
        .select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("root"))
        .distinct()
    )
    current = stored(current if rows is None else in_parts(current, rows), "links")
    before = _fingerprint(current)
    if before[0] == 0:
        return current.select(F.col("child").alias("node"), "root")
    while True:
        both = current.union(current.select("root", "child"))
        smallest = both.groupBy(F.col("child").alias("node")).agg(F.min("root").alias("seen"))
        smallest = smallest.select("node", F.least("node", "seen").alias("low"))
        large = (
            both.where("root > child")
            .withColumnRenamed("child", "node")
            .join(smallest, "node")
            .select(F.col("root").alias("child"), F.col("low").alias("root"))
            .where("child != root")
            .distinct()
        )
        large = stored(in_parts(large, before[0]), "links")
        lowest = large.groupBy("child").agg(F.min("root").alias("low"))
        small = large.join(lowest, "child").select(
            F.explode(
                F.array(
                    F.struct(F.col("root").alias("child"), F.col("low").alias("root")),
                    F.struct("child", F.col("low").alias("root")),
                )
            ).alias("link")
        )
        small = small.select("link.*").where("child != root").distinct()
        current = stored(in_parts(small, 2 * before[0]), "links")
        after = _fingerprint(current)
        if after == before:
            return current.select(F.col("child").alias("node"), "root")
        before = after


def some_of_each(ids: DataFrame, group: str, rows: int) -> DataFrame:
    """At most ``rows`` rows of each value of ``group``: those with the smallest hash of ``id``.

    ``ids`` has a row per id; ``group`` takes few values, whose counts go to the driver. A group
    far above ``rows`` is thinned by hash first, to half as many again, so that what is ranked
    in one task is bounded. Column ``at`` is the rank, from 1.
    """
    counts = {row[group]: row["count"] for row in ids.groupBy(group).count().collect()}
    ranked = ids.withColumn("hash", F.xxhash64("id"))
    large = {key: 1.5 * rows / n for key, n in counts.items() if n > 1.5 * rows}
    if large:
        share = F.create_map(*[F.lit(x) for pair in large.items() for x in pair])
        unit = F.shiftrightunsigned("hash", 11) / float(1 << 53)
        ranked = ranked.where(unit < F.coalesce(F.try_element_at(share, F.col(group)), F.lit(1.0)))
    order = Window.partitionBy(group).orderBy("hash", "id")
    ranked = ranked.withColumn("at", F.row_number().over(order))
    return ranked.where(F.col("at") <= rows).drop("hash")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
