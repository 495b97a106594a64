"""Length buckets with the least padding, and token-budget batches inside each bucket."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_TOKENS = 2048  # sequence length of the model; longer texts are cut into pieces of it
BUCKETS = 8
TOKEN_BUDGET = 16384  # padded tokens of one batch
SLICES = 64  # parts a single length is ordered in, so that a frequent length is many groups


def n_words(text: Column) -> Column:
    """Words between the six ASCII white-space characters; null and empty texts have none."""
    trimmed = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return trimmed.cast("long")


def best_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Bucket boundaries (ascending, the last is the largest length) of least total padding.

    Dynamic programme over the histogram: ``cost[j]`` of the first j lengths in k buckets is the
    least over i < j of cost[i] in k - 1 buckets plus the padding of lengths i..j-1 to length
    j-1. Equal costs: the smallest i. At most ``buckets`` boundaries, fewer lengths give fewer.
    """
    if not lengths:
        return []
    size = np.asarray(lengths, dtype=np.int64)
    rows = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    tokens = np.concatenate([[0], np.cumsum(size * np.asarray(counts, dtype=np.int64))])
    n, unset = len(size), np.iinfo(np.int64).max // 4
    cost = np.full(n + 1, unset)
    cost[0] = 0
    cuts = []
    for _ in range(min(buckets, n)):
        nxt, cut = np.full(n + 1, unset), np.zeros(n + 1, dtype=np.int64)
        for j in range(1, n + 1):
            padded = (rows[j] - rows[:j]) * size[j - 1] - (tokens[j] - tokens[:j])
            total = cost[:j] + padded
            cut[j] = int(np.argmin(total))
            nxt[j] = total[cut[j]]
        cost = nxt
        cuts.append(cut)
    found, j = [], n
    for cut in reversed(cuts):
        found.append(int(size[j - 1]))
        j = int(cut[j])
    return found[::-1]


@dataclass(frozen=True)
class Packed:
    """rows: one row per piece. boundaries: padded length of each bucket."""

    rows: DataFrame
    boundaries: list[int]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = MAX_TOKENS,
    buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET,
    slices: int = SLICES,
) -> Packed:
    """Pieces of whole texts in length buckets and batches.

    Tokens are white-space words. A text of more than ``max_tokens`` is cut into pieces of that
    many and a rest, none is dropped; a text without words (null too) is one piece of length 0.
    The histogram of piece lengths has at most ``max_tokens`` + 1 entries and is all that
    reaches the driver. Bucket k holds lengths above boundary k-1 up to boundary k; a batch holds
    at most max(1, token_budget // max(1, boundary)) pieces of one bucket, filled in order of
    (length, id modulo ``slices``, id, piece). Positions come from counts per (length, slice), so
    no task orders more than one slice of one length. Null ids count as slice 0 and come first;
    repeated rows each get a place; an empty table gives no rows. Other columns are ignored.
    """
    words = n_words(F.col(text_col))
    sized = docs.select(F.col(id_col).alias("id"), words.alias("words"))
    last = F.greatest(F.lit(0), F.ceil(F.col("words") / max_tokens) - 1).cast("int")
    pieces = sized.select(
        "id", "words", F.explode(F.sequence(F.lit(0), last)).alias("piece")
    ).select(
        "id",
        "piece",
        (F.col("piece").cast("long") * max_tokens).alias("first_token"),
        F.least(
            F.lit(max_tokens).cast("long"), F.col("words") - F.col("piece").cast("long") * max_tokens
        ).alias("n_tokens"),
        F.coalesce(F.pmod(F.col("id"), F.lit(slices)), F.lit(0)).cast("int").alias("slice"),
    )
    per_slice = pieces.groupBy("n_tokens", "slice").agg(F.count("*").alias("n"))
    histogram = per_slice.groupBy("n_tokens").agg(F.sum("n").alias("n")).orderBy("n_tokens")
    found = histogram.collect()
    boundaries = best_boundaries([r[0] for r in found], [r[1] for r in found], buckets)
    if not boundaries:
        empty = pieces.select(F.col("id").alias(id_col), "piece", "first_token", "n_tokens")
        return Packed(
            empty.selectExpr("*", "0 bucket", "0L boundary", "0L batch", "0L slot"), boundaries
        )
    limits = F.array(*[F.lit(b).cast("long") for b in boundaries])
    bucket = F.size(F.filter(limits, lambda b: b < F.col("n_tokens"))).alias("bucket")
    before = Window.partitionBy("bucket").orderBy("n_tokens", "slice")
    offsets = per_slice.select("n_tokens", "slice", "n", bucket).select(
        "n_tokens",
        "slice",
        "bucket",
        F.element_at(limits, F.col("bucket") + 1).alias("boundary"),
        (F.sum("n").over(before) - F.col("n")).alias("before"),
    )
    inside = Window.partitionBy("n_tokens", "slice").orderBy(F.asc_nulls_first("id"), "piece")
    placed = (
        pieces.withColumn("at", F.row_number().over(inside) - 1)
        .join(offsets, ["n_tokens", "slice"])
        .withColumn("place", F.col("before") + F.col("at"))
        .withColumn(
            "room",
            F.greatest(
                F.lit(1).cast("long"),
                F.expr(f"{int(token_budget)} div greatest(1, boundary)"),
            ),
        )
    )
    rows = placed.select(
        F.col("id").alias(id_col),
        "piece",
        "first_token",
        "n_tokens",
        "bucket",
        "boundary",
        F.expr("place div room").alias("batch"),
        (F.col("place") % F.col("room")).alias("slot"),
    )
    return Packed(rows, boundaries)
