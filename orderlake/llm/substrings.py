"""Removal of word sequences that an earlier document has: difference-cover anchors.

{1, 2, 4} is a difference cover modulo 7: for any two positions i and j there is a shift d of 0
to 6 with (i + d) mod 7 and (j + d) mod 7 both in it. So of two equal windows of 13 words, however
they lie in their documents, one pair of anchors (7 words at a cover position) is aligned, and
only three of seven positions are hashed and shuffled. Anchors found in two documents mark where
to extend: the windows of 13 words around them are compared in full.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import stored, texts_of

WINDOW = 13
PERIOD = 7
COVER = (1, 2, 4)
CHUNK_WORDS = 1 << 16  # texts are worked on together up to about as many words
FILTER_BITS = 27  # 2^27 bits (16 MB) of shared anchors go to each task; it only saves work
_ANCHOR = 0x9E3779B97F4A7C15
_LOW, _HIGH = 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
_COVERED = np.isin(np.arange(PERIOD), COVER)
_BUCKET = 1 << 15  # bits of one row of the filter (Spark's bitmap functions)


def _word_hashes(words: list[bytes]) -> np.ndarray:
    """Two independent 64-bit hashes per word."""
    digests = b"".join(map(xxhash.xxh3_128_digest, words))
    return np.frombuffer(digests, dtype="<u8").reshape(-1, 2)


def _rolling(hashes: np.ndarray, size: int, factor: int) -> np.ndarray:
    """Hash of every run of ``size`` words."""
    count = max(0, len(hashes) - size + 1)
    total = np.zeros(count, dtype=np.uint64)
    for k in range(size if count else 0):
        total *= np.uint64(factor)
        total += hashes[k : k + count]
    return total ^ (total >> np.uint64(29))


class _Chunk:
    """Some texts one after the other: hashes of their words, place of each word in its text."""

    def __init__(self, words: list[bytes], sizes: list[int]):
        self.low, self.high = np.ascontiguousarray(_word_hashes(words).T)
        self.text = np.repeat(np.arange(len(sizes)), sizes)
        ends = np.cumsum(sizes)
        at = np.arange(len(words))
        self.place = (at - (ends - sizes)[self.text]).astype(np.int32)
        self.left = (ends[self.text] - at).astype(np.int32)  # words from here to the text's end

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of the anchors at cover positions of the texts."""
        size = window - PERIOD + 1
        runs = _rolling(self.low, size, _ANCHOR)
        whole = self.left[: len(runs)] >= size
        at = np.flatnonzero(whole & _COVERED[self.place[: len(runs)] % PERIOD])
        return at, runs[at]

    def candidates(self, marks: _Filter, window: int) -> np.ndarray:
        """Positions of windows that hold an anchor found in the filter."""
        at, anchors = self.anchors(window)
        hits = np.zeros(len(self.left) + PERIOD + 1, dtype=np.int32)
        hits[at[marks.hits(anchors)] + 1] = 1
        before = np.cumsum(hits)
        # window i holds the anchors at i .. i + PERIOD - 1
        held = before[PERIOD : PERIOD + len(self.left)] > before[: len(self.left)]
        return np.flatnonzero(held & (self.left >= window))

    def window_hashes(self, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the windows at ``starts``, as signed integers."""
        found = []
        for hashes, factor in ((self.low, _LOW), (self.high, _HIGH)):
            total = np.zeros(len(starts), dtype=np.uint64)
            for k in range(window):
                total *= np.uint64(factor)
                total += hashes[starts + k]
            found.append((total ^ (total >> np.uint64(29))).view(np.int64))
        return found[0], found[1]


def _chunked(batches: Iterator[pa.RecordBatch], columns: list[str], window: int):
    """(chunk, one array per column with the value of each text) of texts of a window or more."""
    words, sizes, values = [], [], []
    for batch in batches:
        others = [batch.column(c).to_pylist() for c in columns]
        for *value, text in zip(*others, texts_of(batch, "text"), strict=True):
            found = text.split() if text else []
            if len(found) < window:
                continue
            words += found
            sizes.append(len(found))
            values.append(value)
            if len(words) >= CHUNK_WORDS:
                yield _Chunk(words, sizes), np.array(values, dtype=np.int64).T
                words, sizes, values = [], [], []
    if words:
        yield _Chunk(words, sizes), np.array(values, dtype=np.int64).T


class _Filter:
    """Bloom filter with two bits per anchor, built by Spark's bitmap aggregates."""

    def __init__(self, shared: DataFrame, size_log2: int):
        self.shift = 64 - size_log2
        size = 1 << size_log2
        bits = F.array(
            F.col("anchor").bitwiseAND(F.lit(size - 1)),
            F.shiftrightunsigned("anchor", self.shift),
        )
        rows = (
            shared.select(F.explode(bits).alias("bit"))
            .groupBy(F.expr(f"bit div {_BUCKET}").alias("bucket"))
            .agg(F.expr(f"bitmap_construct_agg(bit % {_BUCKET})").alias("bits"))
        )
        packed = bytearray(size // 8)
        for row in rows.toLocalIterator():
            start = row["bucket"] * (_BUCKET // 8)
            packed[start : start + len(row["bits"])] = row["bits"]
        self.sent = shared.sparkSession.sparkContext.broadcast(bytes(packed))

    def hits(self, anchors: np.ndarray) -> np.ndarray:
        packed = np.frombuffer(self.sent.value, dtype=np.uint8)
        size = np.uint64((1 << (64 - self.shift)) - 1)
        found = np.ones(len(anchors), dtype=bool)
        for bit in (anchors & size, anchors >> np.uint64(self.shift)):
            found &= (packed[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def _emit_anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, (ids,) in _chunked(batches, ["id"], window):
            at, found = chunk.anchors(window)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(ids[chunk.text[at]])],
                names=["anchor", "id"],
            )

    return run


def _emit_windows(marks: _Filter, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, (ids, versions) in _chunked(batches, ["id", "version"], window):
            starts = chunk.candidates(marks, window)
            if len(starts):
                text = chunk.text[starts]
                found = [*chunk.window_hashes(starts, window), ids[text], versions[text]]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, found), pa.array(chunk.place[starts])],
                    names=["low", "high", "id", "version", "start"],
                )

    return run


def kept_words(words: list[bytes], starts: np.ndarray, window: int) -> list[bytes]:
    """The words that none of the windows beginning at ``starts`` covers."""
    mark = np.bincount(starts, minlength=len(words) + 1)
    mark -= np.bincount(starts + window, minlength=len(words) + 1)
    return list(compress(words, (np.cumsum(mark[:-1]) == 0).tolist()))


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, kept = [], [], []
            for starts, text in zip(batch.column("starts"), texts_of(batch, "text"), strict=True):
                words = text.split() if text else []
                size.append(len(words))
                if starts.is_valid:
                    at = starts.values.to_numpy()
                    words = kept_words(words, at, window)
                removed.append(size[-1] - len(words))
                kept.append(b" ".join(words).decode())
            columns = [batch.column("id"), *map(pa.array, (size, removed, kept))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_removed", "kept"])

    return run


def drop_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Per row of ``docs``: (id, n_words long, n_removed long, kept string).

    Words lie between the six ASCII white-space characters. A word goes if it lies in a window of
    ``window`` words whose sequence also starts in a document with a smaller id, judged on the
    texts as they came in; ``kept`` is what stays, joined by single spaces. Windows are compared
    by 128 bits of hash.

    Steps: anchors with the smallest and largest id that has them (combined before the shuffle,
    so a passage of many documents is a row per task); anchors of two documents or more fill a
    filter of fixed size; windows around its hits are summed the same way, and joined back to the
    documents that have them. A filter that fills up lets more windows through, never fewer.

    Null and short texts lose nothing; a null id is neither smaller nor larger than any and loses
    nothing; rows that repeat an id do not count against each other; an empty table gives no
    rows; only the two named columns are read. Ids must be whole numbers.
    """
    if window < PERIOD:
        raise ValueError(f"a window needs at least {PERIOD} words")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(text_col).alias("version"),
        F.col(text_col).alias("text"),
    )
    named = rows.where("id is not null")
    anchors = named.select("id", "text").mapInArrow(_emit_anchors(window), "anchor long, id long")
    shared = (
        anchors.groupBy("anchor")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"))
        .where("first < last")
        .select("anchor")
    )
    marks = _Filter(stored(shared, "repeat-anchors"), filter_bits)
    windows = named.mapInArrow(
        _emit_windows(marks, window), "low long, high long, id long, version long, start int"
    )
    repeated = stored(
        windows.groupBy("low", "high")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"))
        .where("first < last")
        .select("low", "high", "first"),
        "repeat-windows",
    )
    removed = stored(
        windows.join(repeated, ["low", "high"])
        .where("first < id")
        .groupBy("id", "version")
        .agg(F.collect_set("start").alias("starts")),
        "repeat-starts",
    )
    joined = rows.join(removed, ["id", "version"], "left").select("id", "starts", "text")
    return joined.mapInArrow(
        _cut(window), "id long, n_words long, n_removed long, kept string"
    ).withColumnRenamed("id", id_col)
