"""Language identification: multinomial logistic regression on character n-grams.

Features are hashed n-grams of one to three characters (letters in lower case, anything else a
space), weighted by term frequency and inverse document frequency, of unit length. Training is
follow-the-regularised-leader with elastic-net penalties on shards whose weights are averaged; a
temperature fitted on rows kept aside calibrates the probabilities.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import crc_bucket, map_rows, some_of_each, texts_of

BUCKETS = 1 << 16  # hashed n-grams
ORDERS = (1, 2, 3)
ROWS_PER_LANGUAGE = 1_500  # rows learned from at most, of each language
SHARDS = 4
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-3, 1e-3
UNKNOWN = "und"
_PRIMES = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
_BIAS = BUCKETS  # one feature that is always there

Vector = tuple[np.ndarray, np.ndarray]


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def ngram_counts(text: bytes | None, letters: np.ndarray) -> np.ndarray | None:
    """Counts per bucket of a whole text; None if it has no letter."""
    if not text:
        return None
    raw = text.decode().lower().encode("utf-32-le")
    codes = np.frombuffer(raw, dtype="<u4")
    is_letter = letters[codes]
    if not is_letter.any():
        return None
    codes = np.where(is_letter, codes, 32).astype(np.uint32)
    codes = np.concatenate([[32], codes[(codes != 32) | np.append(True, codes[:-1] != 32)], [32]])
    codes = codes.astype(np.uint32)
    total = np.zeros(BUCKETS, dtype=np.int64)
    gram = np.zeros(len(codes), dtype=np.uint32)
    for order in ORDERS:
        size = len(codes) - order + 1
        if size <= 0:
            break
        gram = gram[:size] * np.uint32(_PRIMES[0]) + codes[order - 1 : order - 1 + size]
        mixed = gram * np.uint32(_PRIMES[1]) + np.uint32(order * _PRIMES[2] & 0xFFFFFFFF)
        total += np.bincount(mixed >> np.uint32(16), minlength=BUCKETS)
    return total


def vector(counts: np.ndarray, idf: np.ndarray) -> Vector:
    """(buckets, values) of unit length, the bias behind them."""
    at = np.flatnonzero(counts)
    values = (1 + np.log(counts[at])) * idf[at]
    norm = math.sqrt(float(values @ values)) or 1.0
    return np.append(at, _BIAS), np.append(values / norm, 1.0)


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[int, np.ndarray]:
    """(texts with letters, texts per bucket) over all rows; ``BUCKETS`` sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, total, texts = _letters(), np.zeros(BUCKETS + 1, dtype=np.int64), 0
        for batch in batches:
            for text in texts_of(batch, "text"):
                counts = ngram_counts(text, letters)
                if counts is not None:
                    total[:BUCKETS] += counts > 0
                    texts += 1
        total[BUCKETS] = texts
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "n"]
        )

    rows = (
        docs.select(F.col(text_col).alias("text"))
        .mapInArrow(run, "bucket int, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
    )
    found = np.zeros(BUCKETS + 1, dtype=np.int64)
    for row in rows.collect():
        found[row["bucket"]] = row["n"]
    return int(found[BUCKETS]), found[:BUCKETS]


def _ftrl_weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    shrunk = np.sign(z) * L1 - z
    return np.where(np.abs(z) <= L1, 0.0, shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2))


def ftrl(rows: list[tuple[Vector, int]], classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (bucket x class) after ``epochs`` passes in the order given."""
    z = np.zeros((BUCKETS + 1, classes))
    n = np.zeros((BUCKETS + 1, classes))
    for _ in range(epochs):
        for (at, values), label in rows:
            weights = _ftrl_weights(z[at], n[at])
            logits = values @ weights
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            slope = values[:, None] * p
            more = n[at] + slope * slope
            z[at] += slope - (np.sqrt(more) - np.sqrt(n[at])) / ALPHA * weights
            n[at] = more
    return _ftrl_weights(z, n)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search over its logarithm."""

    def loss(log_t: float) -> float:
        x = logits / math.exp(log_t)
        x = x - x.max(axis=1, keepdims=True)
        return float((np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(x)), labels]).mean())

    if not len(logits):
        return 1.0
    low, high, ratio = -4.0, 3.0, (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return math.exp((low + high) / 2)


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
) -> dict | None:
    """{languages, idf, weights, temperature} learned from ``docs``; None without labelled rows.

    Document frequencies count every row. Of each language ``rows_per_language`` ids at most (by
    hash of the id) are learned from, a fifth of them only for the temperature; the ids are sent
    to all tasks. Rows with a null id or language, or without a letter, teach nothing.
    """
    texts, frequency = document_frequencies(docs, text_col)
    idf = np.log((1 + texts) / (1 + frequency)) + 1
    labelled = (
        docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"))
        .where("id is not null and lang is not null")
        .groupBy("id")
        .agg(F.min("lang").alias("lang"))
    )
    ids = some_of_each(labelled, "lang", rows_per_language)
    languages = [r["lang"] for r in ids.select("lang").distinct().orderBy("lang").collect()]
    if not languages:
        return None
    place = {lang: k for k, lang in enumerate(languages)}
    chosen = ids.select("id", "lang", (F.col("at") % 5 == 0).alias("aside"), "at")
    sample = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(chosen), "id")
        .select("aside", "at", "lang", "text")
    )
    sent = docs.sparkSession.sparkContext.broadcast(idf)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, rows = _letters(), []
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lang, text in zip(langs, texts_of(batch, "text"), strict=True):
                counts = ngram_counts(text, letters)
                if counts is not None:
                    rows.append((vector(counts, sent.value), place[lang]))
        weights = ftrl(rows, len(languages))
        at, kind = np.nonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(at.astype(np.int32)),
                pa.array(kind.astype(np.int32)),
                pa.array(weights[at, kind]),
            ],
            names=["bucket", "language", "weight"],
        )

    shard = F.pmod(F.col("at"), F.lit(SHARDS))
    parts = (
        sample.where("not aside")
        .withColumn("shard", shard)
        .repartition(SHARDS, "shard")
        .sortWithinPartitions("shard", F.xxhash64("at", "lang"), "text")
        .select("lang", "text")
        .mapInArrow(fit, "bucket int, language int, weight double")
        .groupBy("bucket", "language")
        .agg(F.sum("weight").alias("weight"))
    )
    weights = np.zeros((BUCKETS + 1, len(languages)))
    for row in parts.collect():
        weights[row["bucket"], row["language"]] = row["weight"] / SHARDS
    model = {"languages": languages, "idf": idf, "weights": weights, "temperature": 1.0}
    ready = docs.sparkSession.sparkContext.broadcast(model)
    held = map_rows(
        sample.where("aside").select("lang", "text"),
        "label int, logits array<double>",
        ["lang", "text"],
        lambda state, lang, text: (place[lang], _logits(state, text)),
        lambda: (ready.value, _letters()),
    ).collect()
    held = [r for r in held if r["logits"]]
    model["temperature"] = temperature(
        np.array([r["logits"] for r in held]), np.array([r["label"] for r in held], dtype=int)
    )
    return model


def _logits(state, text: bytes | None) -> list[float] | None:
    model, letters = state
    counts = ngram_counts(text, letters)
    if counts is None:
        return None
    at, values = vector(counts, model["idf"])
    return (values @ model["weights"][at]).tolist()


def identify(
    docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: (id, lang_pred, score).

    The likeliest learned language (ties: the first by name) and its calibrated probability. Null
    texts and texts without a letter are ``und`` with score 0, and so is all if nothing was learned.
    Repeated rows are each reported; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def one(state, key, text):
        logits = _logits(state, text) if state[0] else None
        if logits is None:
            return key, UNKNOWN, 0.0
        x = np.array(logits) / state[0]["temperature"]
        p = np.exp(x - x.max())
        best = int(np.argmax(p))
        return key, state[0]["languages"][best], float(p[best] / p.sum())

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
        f"id {kind}, lang_pred string, score double",
        ["id", "text"],
        one,
        lambda: (sent.value, _letters()),
    ).withColumnRenamed("id", id_col)


def learnable(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows to learn from: crc32 of the id modulo 5 is not 0."""
    return docs.where(crc_bucket(id_col, 5) != 0)


def is_held_out(id_col: str = "doc_id"):
    return F.coalesce(crc_bucket(id_col, 5) == 0, F.lit(False))
