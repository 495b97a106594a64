"""Exact top-k by inner product: tiles of queries against shards of candidates."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_TILE = 2048  # queries of one tile at most, up to the evenness of a hash
SHARD_ROWS = 16384  # candidates of one shard, likewise
FAN_IN = 16  # shards whose lists one node of the merge tree joins


def quantised(frame: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v array<double>): floor(scale * x) of usable vectors, one row per id.

    Left out: null ids, null or empty vectors, and vectors with a null or non-finite component.
    Rows that repeat an id with another vector: the smallest vector counts.
    """
    raw = frame.select(F.col(id_col).alias("id"), F.col(vector_col).alias("raw"))
    finite = F.forall(
        "raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    whole = raw.where(F.col("id").isNotNull() & (F.size("raw") > 0) & finite)
    # floor() of a double gives a long and would wrap beyond it; x - x mod 1 stays a double
    scaled = F.transform("raw", lambda x: F.lit(float(scale)) * x.cast("double"))
    floored = F.transform(scaled, lambda x: x - F.pmod(x, F.lit(1.0)))
    return whole.groupBy("id").agg(F.min(floored).alias("v"))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of one row, best first; ``ids`` ascend, so ties go to the smaller."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > floor)
        level = np.flatnonzero(scores == floor)[: k - len(above)]
        at = np.concatenate([above, level])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))]


def _exact_product(queries: np.ndarray, candidates: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Inner products as int64: by floating-point matrix product while every partial sum is an
    exact integer, else in Python integers. Products beyond 64 bits raise OverflowError, but for
    those of a vector with itself (``own``), which nobody asks for."""
    bound = np.abs(queries).max() * np.abs(candidates).max() * queries.shape[1]
    if bound < 2.0**53:
        return (queries @ candidates.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in queries], dtype=object)
    others = np.array([[int(x) for x in row] for row in candidates], dtype=object)
    products = exact.dot(others.T)
    products[own] = 0
    return products.astype(np.int64)


def _tile_lists(k: int):
    def lists(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(candidates):
            candidates = candidates.sort_values("id")
            ids = candidates["id"].to_numpy()
            shard = int(candidates["shard"].iloc[0])
            right = np.array(candidates["v"].tolist(), dtype=np.float64)
            keys = queries["id"].to_numpy()
            left = np.array(queries["v"].tolist(), dtype=np.float64)
            step = max(1, (1 << 22) // len(ids))
            for at in range(0, len(keys), step):
                own = keys[at : at + step, None] == ids
                scores = _exact_product(left[at : at + step], right, own)
                for query, row in zip(keys[at : at + step], scores, strict=True):
                    other = ids != query
                    best = _best(row[other], ids[other], k)
                    found.append((query, ids[other][best], row[other][best]))
        return pd.DataFrame(
            {
                "query_id": np.concatenate([np.full(len(i), q) for q, i, _ in found] or [[]]),
                "vec_id": np.concatenate([i for _, i, _ in found] or [[]]),
                "score": np.concatenate([s for _, _, s in found] or [[]]),
                "shard": shard if found else 0,
            }
        ).astype("int64")

    return lists


def exact_top_k(
    candidates: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest integer inner products per query.

    Vectors are quantised to floor(scale * x). Queries and candidates are dealt by a hash of the
    id into tiles and shards; tile x shard cells are tasks of bounded size that each return at
    most k rows per query. Lists are merged in a tree of FAN_IN. Ties go to the smaller id, a
    query never meets its own id, and vectors of different length are never compared. A query
    without partner has no row; empty inputs give an empty result; other columns are ignored.
    Ids must be whole numbers.
    """
    points = quantised(candidates, id_col, vector_col, scale)
    asked = quantised(queries, id_col, vector_col, scale)
    tiles = max(1, math.ceil(queries.count() / QUERY_TILE))
    shards = max(1, math.ceil(candidates.count() / SHARD_ROWS))
    span = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    size = F.size("v").alias("size")
    place = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    left = asked.select("id", "v", size, place(tiles).alias("tile"), span(shards).alias("shard"))
    right = points.select("id", "v", size, place(shards).alias("shard"), span(tiles).alias("tile"))
    key = ["size", "tile", "shard"]
    lists = (
        left.groupBy(*key)
        .cogroup(right.groupBy(*key))
        .applyInPandas(_tile_lists(k), "query_id long, vec_id long, score long, shard long")
    )

    def merged(rows: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    while shards > FAN_IN:
        shards = math.ceil(shards / FAN_IN)
        lists = lists.withColumn("shard", F.floor(F.col("shard") / FAN_IN))
        lists = merged(lists, "query_id", "shard").drop("rank")
    return merged(lists, "query_id").select("query_id", "rank", "vec_id", "score")
