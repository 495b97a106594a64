import math
import random

from orderlake.llm import topk


def brute(rows, k):
    usable = {
        i: [math.floor(256 * x) for x in v]
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    }
    found = set()
    for q in (i for i in usable if i % 50 == 0):
        scores = sorted(
            (-sum(a * b for a, b in zip(usable[q], v, strict=True)), i)
            for i, v in usable.items()
            if i != q and len(v) == len(usable[q])
        )
        found |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return found


def result(frame):
    return {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in frame.collect()}


def test_like_brute_force_with_ties_and_unusable_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 20)
    monkeypatch.setattr(topk, "QUERY_TILE", 3)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    draw = random.Random(5)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(6)]) for i in range(0, 300)]
    rows += [(1000 + i, [0.25] * 6) for i in range(40)]  # one common vector
    rows += [(1040, None), (1050, [1.0, None] + [0.0] * 4), (1051, [float("nan")] * 6)]
    rows += [(1052, [float("inf")] * 6), (1053, []), (None, [1.0] * 6), (1100, [2.0, 2.0])]
    rows = [(i, v and [x if x is None else float(x) for x in v]) for i, v in rows]
    vectors = spark.createDataFrame(
        [(*row, "clash", "clash") for row in rows],
        "vec_id long, embedding array<double>, shard string, v string",
    )
    found = topk.exact_top_k(vectors, vectors.where("vec_id % 50 = 0"))
    assert result(found) == brute(rows, 5)


def test_repeated_rows_count_once_and_no_rows(spark):
    rows = [(50, [1.0, 1.0]), (50, [1.0, 1.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = topk.exact_top_k(vectors, vectors.where("vec_id % 50 = 0"))
    assert result(found) == {(50, 1, 1, 65536)}
    empty = vectors.where("false")
    assert topk.exact_top_k(empty, empty).count() == 0
    assert topk.exact_top_k(vectors, empty).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(50, [3.0e7, 1.0]), (1, [1.0e6 + 1 / 256, 0.5]), (2, [1.0e6, 0.5])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert result(topk.exact_top_k(vectors, vectors.where("vec_id = 50"))) == brute(rows, 5)
