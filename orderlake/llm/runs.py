"""Periodic runs of words: maximal pairs from the LCP-interval tree of each text.

Two starts i < j whose texts agree for exactly n words, and whose left words differ, are a maximal
pair. One with n >= (k - 1) * (j - i) is a run already: words i to j + n repeat with period j - i
at least k times, the left words stop it on one side and the first disagreement on the other, so
nothing is left to extend. A run comes out once for each multiple of its period that still fits;
the least distance of a stretch is its period.

The suffixes of a text are sorted by doubling, the tree of their common prefixes is walked from
the deepest interval up, and an interval keeps the starts below it in text order together with
the class of their left words. Joining two children, only starts close enough to each other can
make a run, and all occurrences of one prefix that close lie at equal distances, where every one
but the first has the same left word. So a start meets at most two others: the first one in reach
before it and the next one behind it, and intervals of one class are joined unseen.

Everything happens inside a row: there is no shuffle, and a text is the unit that must fit a task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import map_rows

MIN_LENGTH = 6
MIN_PERIODS = 4
_FACTORS = np.random.default_rng(13).integers(1, 1 << 62, 64, dtype=np.uint64) * 2 + 1
Run = tuple[int, int, int]


def shortest_pair(min_length: int, min_periods: int) -> int:
    """Words that the two parts of any run's maximal pair have in common, at least."""
    return min(max(min_length - q, (min_periods - 1) * q) for q in range(1, max(2, min_length)))


def _repeats(ids: np.ndarray, size: int) -> bool:
    """Whether some stretch of ``size`` words occurs twice (by hash; a false yes does no harm)."""
    count = len(ids) - size + 1
    if count < 2:
        return False
    total = np.zeros(count, dtype=np.uint64)
    words = ids.astype(np.uint64) + np.uint64(1)
    for k in range(size):
        total += words[k : k + count] * _FACTORS[k % len(_FACTORS)]
        total ^= total >> np.uint64(31)
        total *= _FACTORS[0]
    total.sort()
    return bool((total[1:] == total[:-1]).any())


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts in the order of their suffixes, words each shares with the one before it)."""
    n = len(ids)
    ranks = [ids.astype(np.int64)]
    width = 1
    while True:
        now = ranks[-1]
        follow = np.zeros(n, dtype=np.int64)
        follow[: n - width] = now[width:] + 1
        _, rank = np.unique(now * (n + 1) + follow, return_inverse=True)
        width *= 2
        if rank.max(initial=0) == n - 1:
            break
        ranks.append(rank)
    order = np.argsort(rank)
    one, other = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(n, dtype=np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        at = np.flatnonzero((one < n) & (other < n))
        at = at[ranks[level][one[at]] == ranks[level][other[at]]]
        step = 1 << level
        one[at] += step
        other[at] += step
        shared[at + 1] += step
    return order, shared


class _Starts:
    """The starts below an interval, in text order; ``left`` is their one left word, if one."""

    __slots__ = ("at", "left")

    def __init__(self, start: int, left: int):
        self.at = [start]
        self.left: int | None = left

    def take(self, other: _Starts) -> None:
        if len(other.at) * 8 < len(self.at):
            for start in other.at:
                insort(self.at, start)
        else:
            self.at += other.at
            self.at.sort()
        if self.left != other.left:
            self.left = None


def maximal_pairs(ids: np.ndarray, min_length: int, min_periods: int):
    """(i, j, n): maximal pairs i < j sharing n words that are runs of ``min_length`` words or more
    and ``min_periods`` periods or more (3 at least)."""
    least = shortest_pair(min_length, min_periods)
    if not _repeats(ids, least):
        return
    order, shared = suffix_order(ids)
    left = [-1, *ids[:-1].tolist()]

    def joined(one: _Starts, other: _Starts, n: int):
        """Pairs between two children of an interval, and the children as one."""
        small, large = sorted((one, other), key=lambda s: len(s.at))
        found = []
        if small.left is None or small.left != large.left:
            reach, at = n // (min_periods - 1), large.at
            for start in small.at:
                word = left[start]
                k = bisect_left(at, start - reach)
                if k < len(at) and at[k] < start and left[at[k]] != word:
                    found.append((at[k], start, n))
                k = bisect_right(at, start)
                if k < len(at) and at[k] <= start + reach and left[at[k]] != word:
                    found.append((start, at[k], n))
        large.take(small)
        return found, large

    # open intervals from the root down, each with the starts to its left, as (shared words, starts)
    open_: list[tuple[int, _Starts]] = []
    starts, depths = order.tolist(), shared.tolist()
    for k, start in enumerate(starts):
        depth = depths[k + 1] if k + 1 < len(starts) else 0
        if depth < least and not open_:
            continue
        node = _Starts(start, left[start])
        while open_ and open_[-1][0] >= depth:
            n, before = open_.pop()
            found, node = joined(before, node, n)
            for pair in found:
                if pair[1] - pair[0] + n >= min_length:
                    yield pair
        if depth >= least:
            open_.append((depth, node))


def runs_of(
    words: list[bytes], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS
) -> list[Run]:
    """(start, length, period) of all runs, by start and period."""
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    least: dict[tuple[int, int], int] = {}
    for i, j, n in maximal_pairs(ids, min_length, min_periods):
        stretch = (i, j + n)
        least[stretch] = min(j - i, least.get(stretch, j - i))
    return sorted((start, end - start, period) for (start, end), period in least.items())


def without_repetitions(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run covers behind its first period."""
    if not runs:
        return words
    mark = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        mark[start + period] += 1
        mark[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(mark[:-1]) == 0).tolist()]


def looped(key: int | None, words: list[bytes]) -> list[bytes]:
    """Planted runs: of a tenth of the ids, the words from some place on repeat with some period,
    both drawn from the id. Null ids are left alone."""
    if key is None or not words:
        return words
    draw, rest = divmod(zlib.crc32(str(key).encode()), 10)
    if rest:
        return words
    n = len(words)
    first = draw % n
    period = 1 + (n - first) // (3 + draw % 8)
    block = words[first : first + period]
    return words[:first] + (block * ((n - first) // period + 1))[: n - first]


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_periods: int = MIN_PERIODS,
    prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """Per row of ``docs``: (id, n_words long, runs array<struct<start, length, period>>, collapsed).

    Words lie between the six ASCII white-space characters and are compared as they are. A run is
    a stretch with smallest period p of at least ``min_length`` words and ``min_periods`` * p words
    that neither neighbour prolongs; runs come by start, then period. ``collapsed`` are the words
    that no run covers behind its first p words, joined by single spaces. ``prepare`` may rewrite
    the words of an id first.

    Null and empty texts have no words and no runs; repeated rows are each reported, null ids too;
    an empty table gives no rows; only the two named columns are read. Ids must be whole numbers.
    """
    if min_periods < 3:
        raise ValueError("a maximal pair shows its run from three periods on")

    def one(_, key, text):
        words = text.split() if text else []
        if prepare:
            words = prepare(key, words)
        runs = runs_of(words, min_length, min_periods)
        return key, len(words), runs, b" ".join(without_repetitions(words, runs)).decode()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    span = "struct<start: long, length: long, period: long>"
    found = map_rows(
        rows, f"id long, n_words long, runs array<{span}>, collapsed string", ["id", "text"], one
    )
    return found.withColumnRenamed("id", id_col)
