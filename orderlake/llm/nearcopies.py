"""Near copies: SimHash on the segment-count grid, MinHash cells for the rest, exact check behind.

A text is the set of its five-word shingles. SimHash comes first: fingerprints of those shingles
meet in the grid of segment bit counts (``simhash.near_links``), and what is linked there is
compared by the shingles themselves. Its grid serves fingerprints that differ in few bits; two
texts of similarity 0.8 differ in about ten.

The rest is found in MinHash cells. Five minima of the set under random orders make a
cell, and each text enters 30 of them: two texts of similarity 0.8 miss each other in all cells
in 7 of a million cases, more alike ones more rarely. What meets in a cell is compared by the
shingles themselves, first with the smallest and largest member of its cell (few comparisons for
a large group, none with what SimHash has joined to it), then with every member that these links
have not joined to it already. That second
part is a set join inside tasks: a cell's members that are not of its largest group meet that group
and each other in tiles of bounded size, where the rarest fifth of the shingles of either text must
have one in common, and only links that join something leave the task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm import simhash
from orderlake.llm.common import connected, map_rows, stored, texts_of

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, MINIMA = 30, 5
TILE_SHINGLES = 1 << 17  # shingles of one side of a tile, up to the evenness of a hash
_AT_ONCE = 2048
_DRAWN = np.random.default_rng(7).integers(0, 1 << 63, (2, BANDS * MINIMA), dtype=np.uint64)
_XOR, _TIMES = _DRAWN[0], _DRAWN[1] << np.uint64(1) | np.uint64(1)


def shingles(text: bytes | None, size: int = SHINGLE_WORDS) -> set[bytes]:
    """The distinct runs of ``size`` words; fewer words are one run, no words none."""
    words = text.lower().split() if text else []
    if not words:
        return set()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def cells(held: set[bytes]) -> list[int]:
    """The cells of a set, one per band, as signed integers."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, held), dtype=np.uint64, count=len(held))
    least = np.full(BANDS * MINIMA, ~np.uint64(0))
    for at in range(0, len(hashes), _AT_ONCE):
        some = hashes[at : at + _AT_ONCE, None]
        least = np.minimum(least, ((some ^ _XOR) * _TIMES).min(axis=0))
    bands = least.reshape(BANDS, MINIMA)
    found = np.array([xxhash.xxh64_intdigest(b.tobytes(), k) for k, b in enumerate(bands)], np.uint64)
    return found.view(np.int64).tolist()


def similar(one: set[bytes], other: set[bytes], similarity: float = SIMILARITY) -> bool:
    """Jaccard similarity at or above the threshold; sets without shingles are alike."""
    both = len(one & other)
    return both >= similarity * (len(one) + len(other) - both) - 1e-9


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(a, b): the pairs whose texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, known = None, set()
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            keep = []
            for x, one, other in zip(a, texts_of(batch, "one"), texts_of(batch, "other"), strict=True):
                if x != key:
                    key, known = x, shingles(one)
                keep.append(similar(known, shingles(other), similarity))
            kept = pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            yield kept.filter(pa.array(keep, pa.bool_()))

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("one"))
    other = texts.select(F.col("node").alias("b"), F.col("text").alias("other"))
    both = pairs.join(other, "b").join(one, "a").select("a", "b", "one", "other")
    return both.mapInArrow(run, "a long, b long")


def joining_pairs(
    members: list[tuple[int, int, int, set[bytes]]], crosswise: bool, similarity: float
) -> Iterator[tuple[int, int]]:
    """Similar pairs of members (node, root, side, shingles) that join different roots, and joins
    them: no pair comes out whose roots earlier pairs have joined. ``crosswise``: only pairs of
    members on different sides count.

    Two sets of that similarity share a shingle among the first n - similarity * n + 1 of either,
    in any one order; rare ones come first, so that few sets meet there.
    """
    joined: dict[int, int] = {}

    def top(root: int) -> int:
        while (above := joined.get(root, root)) != root:
            joined[root] = joined.get(above, above)
            root = above
        return root

    often = Counter(s for *_, held in members for s in held)
    met: dict[bytes, list[int]] = {}
    members = sorted(members, key=lambda m: (len(m[3]), m[0]))
    for at, (node, root, side, held) in enumerate(members):
        size = len(held)
        first = size - math.ceil(similarity * size - 1e-9) + 1
        prefix = sorted(held, key=lambda s: (often[s], s))[:first]
        seen = set()
        for shingle in prefix:
            for k in met.get(shingle, ()):
                if k in seen:
                    continue
                seen.add(k)
                other, other_root, other_side, other_held = members[k]
                if crosswise and side == other_side or len(other_held) + 1e-9 < similarity * size:
                    continue
                one, two = top(root), top(other_root)
                if one != two and similar(held, other_held, similarity):
                    joined[max(one, two)] = min(one, two)
                    yield min(node, other), max(node, other)
            met.setdefault(shingle, []).append(at)


def _joined(open_rows: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links between similar members of a cell whose roots differ, enough to join them."""
    shares = open_rows.groupBy("cell", "root").agg(F.sum("n").alias("n"), F.count("*").alias("rows"))
    largest = F.struct("rows", "root")
    cells_ = shares.groupBy("cell").agg(
        F.max_by("root", largest).alias("main"),
        F.max_by("n", largest).alias("main_n"),
        F.sum("n").alias("all_n"),
    )
    blocks = lambda n: F.greatest(F.ceil(n / TILE_SHINGLES), F.lit(1)).cast("int")
    dealt = open_rows.join(cells_, "cell").select(
        "cell", "node", "root",
        (F.col("root") == F.col("main")).alias("is_main"),
        (F.col("all_n") <= TILE_SHINGLES).alias("is_small"),
        blocks(F.col("main_n")).alias("mains"),
        blocks(F.col("all_n") - F.col("main_n")).alias("others"),
    )
    own = F.pmod(F.xxhash64("cell", "node"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("others")))

    def tile(kind: str, one, two, side):
        return F.struct(
            F.lit(kind).alias("kind"), one.cast("int").alias("one"), two.cast("int").alias("two"),
            F.lit(side).cast("int").alias("side") if isinstance(side, int) else side.alias("side"),
        )

    upto = lambda n: F.sequence(F.lit(0), n - 1)
    zero = F.lit(0)
    tiles = (
        F.when(F.col("is_small"), F.array(tile("all", zero, zero, 0)))
        .when(F.col("is_main"), F.transform(upto(F.col("others")), lambda b: tile("main", b, own, 1)))
        .otherwise(
            F.concat(
                F.transform(upto(F.col("mains")), lambda b: tile("main", own, b, 0)),
                F.transform(
                    upto(F.col("others")),
                    lambda b: tile("other", F.least(own, b), F.greatest(own, b), (own > b).cast("int")),
                ),
            )
        )
    )
    placed = dealt.select("cell", "node", "root", F.explode(tiles).alias("tile")).select(
        "cell", "node", "root", "tile.*"
    )
    key = ["cell", "kind", "one", "two"]
    flow = placed.join(texts, "node").select(*key, "side", "node", "root", "text")
    flow = flow.repartition(*key).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(now, members):
            _, kind, one, two = now
            crosswise = kind == "main" or kind == "other" and one != two
            pairs = list(joining_pairs(members, crosswise, similarity))
            a, b = zip(*pairs) if pairs else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        now, members = None, []
        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in key], strict=True)
            rest = [batch.column(c).to_pylist() for c in ("node", "root", "side")]
            for tile_key, node, root, side, text in zip(keys, *rest, texts_of(batch, "text"), strict=True):
                if tile_key != now:
                    if len(members) > 1:
                        yield found(now, members)
                    now, members = tile_key, []
                members.append((node, root, side, shingles(text)))
        if len(members) > 1:
            yield found(now, members)

    return flow.mapInArrow(run, "a long, b long")


def _apart(pairs: DataFrame, group: DataFrame) -> DataFrame:
    """The pairs (a, b) that the groups (node, root) do not hold together yet."""
    one = group.select(F.col("node").alias("a"), F.col("root").alias("one"))
    other = group.select(F.col("node").alias("b"), F.col("root").alias("other"))
    both = pairs.join(one, "a", "left").join(other, "b", "left")
    return both.where(F.coalesce("one", "a") != F.coalesce("other", "b")).select("a", "b")


def simhash_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b) of text hashes: texts whose fingerprints the segment-count grid links, and texts of
    one fingerprint with the first of them. ``nodes`` has the columns node and simhash."""
    prints = stored(nodes.groupBy("simhash").agg(F.min("node").alias("first")), "near-simhash")
    near = simhash.near_links(prints.select(F.col("simhash").alias("a"))).distinct()
    one = prints.select(F.col("simhash").alias("a"), F.col("first").alias("one"))
    other = prints.select(F.col("simhash").alias("b"), F.col("first").alias("other"))
    across = near.join(one, "a").join(other, "b").select("one", "other")
    within = nodes.join(prints, "simhash").where("node != first").select(
        F.col("first").alias("one"), F.col("node").alias("other")
    )
    return across.union(within).select(
        F.least("one", "other").alias("a"), F.greatest("one", "other").alias("b")
    )


def _links(docs: DataFrame, nodes: DataFrame, text_col: str, similarity: float) -> DataFrame:
    """(a, b) of text hashes: links that join all similar texts that share a cell or that SimHash
    links."""
    hashed = stored(simhash_pairs(nodes).distinct(), "near-simhash-pairs")
    exploded = nodes.select("node", "n", F.explode("cells").alias("cell"))
    ends = exploded.groupBy("cell").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("held")
    )
    shared = stored(exploded.join(ends.where("low != high"), "cell"), "near-cells")
    met = shared.select("node").union(hashed.select("a")).union(hashed.select("b"))
    texts = (
        docs.select(F.xxhash64(text_col).alias("node"), F.col(text_col).alias("text"))
        .join(met.distinct(), "node", "left_semi")
        .groupBy("node")
        .agg(F.first("text").alias("text"))
    )
    texts = stored(texts, "near-texts")
    linked = stored(_verified(hashed, texts, similarity), "near-simhash-links")
    group = connected(linked, linked.count())
    star = shared.select("node", F.explode(F.array("low", "high")).alias("end"))
    first = star.where("node != end").select(
        F.least("node", "end").alias("a"), F.greatest("node", "end").alias("b")
    )
    apart = _apart(first.distinct(), group)
    links = linked.union(_verified(apart, texts, similarity))
    links = stored(links, "near-links")
    member = connected(links, links.count())
    open_rows = (
        shared.where("held > 2")
        .join(member, "node", "left")
        .select("cell", "node", "n", F.coalesce("root", "node").alias("root"))
    )
    roots = open_rows.groupBy("cell").agg(F.min("root").alias("lowest"), F.max("root").alias("highest"))
    mixed = roots.where("lowest != highest").select("cell")
    open_rows = stored(open_rows.join(mixed, "cell", "left_semi"), "near-open")
    return links.union(_joined(open_rows, texts, similarity))


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the smallest id (null ids
    last).

    Texts are linked if the Jaccard similarity of their five-word shingles is ``similarity`` or
    more; SimHash groups them first, MinHash cells find what its radius leaves apart. A group is
    what links reach. All columns stay. Null texts and texts without words are
    alike. Among rows that repeat an id, the smaller text hash stays, and one row of those that
    repeat the text too.
    """
    named = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("node"), F.col(text_col).alias("text")
    )

    def one(_, key, node, text):
        held = shingles(text)
        return key, node, simhash.fingerprint(text, SHINGLE_WORDS), len(held), cells(held)

    kind = docs.schema[id_col].dataType.simpleString()
    prints = stored(
        map_rows(
            named,
            f"id {kind}, node long, simhash long, n long, cells array<long>",
            ["id", "node", "text"],
            one,
        ),
        "near-prints",
    )
    nodes = prints.groupBy("node").agg(
        F.min("simhash").alias("simhash"), F.min("n").alias("n"), F.min("cells").alias("cells")
    )
    member = connected(_links(docs, nodes, text_col, similarity))
    first = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("node")))
    # one row per text before the join, so that a text copied often is one row
    lowest = prints.groupBy("node").agg(first.alias("first"))
    rooted = lowest.join(member, "node", "left").withColumn("group", F.coalesce("root", "node"))
    kept = rooted.groupBy("group").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.id").alias("_id"), F.col("first.node").alias("_hash"))
    marked = docs.withColumn("__orderlake_text_hash", F.xxhash64(text_col))
    same = marked[id_col].eqNullSafe(kept["_id"]) & (marked["__orderlake_text_hash"] == kept["_hash"])
    survivors = marked.join(kept, same, "left_semi")
    return survivors.dropDuplicates([id_col, "__orderlake_text_hash"]).drop("__orderlake_text_hash")
