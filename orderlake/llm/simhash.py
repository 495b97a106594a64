"""Near duplicates by SimHash: segment bit counts as a grid, Manhattan bound, exact check.

A fingerprint is cut into 32 segments of two bits. The vector of segment bit counts is an
embedding into the grid {0,1,2}^32, and the Manhattan distance of two such vectors never
exceeds the Hamming distance of the fingerprints. Counts are kept as unary codes (0 -> 00,
1 -> 01, 2 -> 11), so the Manhattan distance is the bit count of an exclusive or.

Range join: the segments form seven blocks. Within Manhattan distance 4 at most four blocks
differ, so at least three agree; each fingerprint enters the 35 cells of three blocks each and
meets there every fingerprint it can be linked with. Inside a cell the Manhattan bound is
tested first, the Hamming distance decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import connected, map_rows, stored

SHINGLE_WORDS = 4
MAX_BITS = 4
BLOCKS = 7  # of 32 segments; MAX_BITS of them may differ, the other three agree
CHUNK = 4096  # fingerprints of one cell handled together; larger cells go on in tiles
_LINKS = "a long, b long, c int, cell long, chunk int"
_EVEN = 0x5555555555555555
_COUNTED_AT_ONCE = 1 << 16


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text as a signed integer.

    Bit b is set if more than half of the shingles (repeats included) have it set in their
    XXH64. Fewer words than a shingle: the whole sequence is one. No words or null: zero.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.zeros(len(words), dtype=np.int64)
    np.cumsum(lengths[:-1] + 1, out=starts[1:])
    size = min(shingle_words, len(words))
    first, last = starts[: len(words) - size + 1], (starts + lengths)[size - 1 :]
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(first), _COUNTED_AT_ONCE):
        a, b = first[at : at + _COUNTED_AT_ONCE].tolist(), last[at : at + _COUNTED_AT_ONCE].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = map(digest, map(joined.__getitem__, map(slice, a, b)), repeat(42))
        values = np.fromiter(hashes, dtype=np.uint64, count=len(a))
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(set_bits * 2 > len(first), bitorder="little").view(np.int64)
    return int(packed[0])


def unary_counts(bits: np.ndarray) -> np.ndarray:
    """Bit counts of the two-bit segments in unary code, packed like the fingerprint."""
    even = np.uint64(_EVEN)
    one, other = bits & even, (bits >> np.uint64(1)) & even
    return ((one & other) << np.uint64(1)) | one | other


def _block_masks() -> list[int]:
    edges = [round(32 * k / BLOCKS) for k in range(BLOCKS + 1)]
    return [((1 << 2 * (b - a)) - 1) << 2 * a for a, b in zip(edges, edges[1:], strict=False)]


def _cells(prints: DataFrame) -> DataFrame:
    """(c, cell, a): each fingerprint in every cell of three blocks."""
    even = F.lit(_EVEN)
    one = F.col("a").bitwiseAND(even)
    other = F.shiftrightunsigned("a", 1).bitwiseAND(even)
    both = F.shiftleft(one.bitwiseAND(other), 1)
    coded = prints.select("a", both.bitwiseOR(one).bitwiseOR(other).alias("coded"))
    masks = [sum(chosen) for chosen in combinations(_block_masks(), BLOCKS - MAX_BITS)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("c"), F.col("coded").bitwiseAND(F.lit(m)).alias("cell"))
            for c, m in enumerate(signed)
        ]
    )
    return coded.select("a", F.explode(cells).alias("at")).select("at.c", "at.cell", "a")


def _near(one: np.ndarray, other: np.ndarray, max_bits: int) -> np.ndarray:
    """Manhattan distance of the segment counts as the lower bound, then the Hamming distance."""
    near = np.bitwise_count(unary_counts(one) ^ unary_counts(other)) <= max_bits
    return near & (np.bitwise_count(one ^ other) <= max_bits)


def local_components(prints: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) of the components among distinct fingerprints, roots left out.

    Grows one component at a time; a member is compared only with what no component has yet, so
    a tight group of n copies takes about n comparisons and leaves n - 1 links.
    """
    members, roots, rest = [], [], prints
    coded = unary_counts(rest)
    while rest.size > 1:
        root, front = rest[0], [(rest[0], coded[0])]
        rest, coded = rest[1:], coded[1:]
        while front and rest.size:
            bits, code = front.pop()
            near = np.bitwise_count(coded ^ code) <= max_bits
            if near.any():
                near[near] = np.bitwise_count(rest[near] ^ bits) <= max_bits
                found = rest[near]
                members.append(found)
                roots.append(np.full(found.size, root))
                front.extend(zip(found, coded[near], strict=True))
                rest, coded = rest[~near], coded[~near]
    none = np.zeros(0, dtype=np.uint64)
    return np.concatenate([none, *members]), np.concatenate([none, *roots])


def _links_in_cells(max_bits: int):
    """mapInArrow over rows sorted by cell: links inside small cells; a cell beyond CHUNK is
    linked chunk by chunk and its rows pass on, marked with their chunk."""
    small = 16

    def batch(a, b, c=None, cell=None, chunk=None) -> pa.RecordBatch:
        n = len(a)
        some = lambda x, kind: pa.nulls(n, kind) if x is None else pa.array(x, kind)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.asarray(a).view(np.int64)),
                pa.nulls(n, pa.int64()) if b is None else pa.array(np.asarray(b).view(np.int64)),
                some(c, pa.int32()),
                some(cell, pa.int64()),
                some(chunk, pa.int32()),
            ],
            names=["a", "b", "c", "cell", "chunk"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, chunks = None, np.zeros(0, dtype=np.uint64), 0

        def resolved(last: bool):
            """Links of what is held of the current cell; its rows too, if it is a large one."""
            nonlocal chunks
            yield batch(*local_components(held, max_bits))
            if not last or chunks:
                n = len(held)
                yield batch(held, None, np.full(n, key[0]), np.full(n, key[1]), np.full(n, chunks))
            chunks += 1

        for rows in batches:
            c = rows.column("c").to_numpy()
            cell = rows.column("cell").to_numpy()
            bits = rows.column("a").to_numpy().view(np.uint64)
            if not len(bits):
                continue
            change = np.flatnonzero((np.diff(c) != 0) | (np.diff(cell) != 0)) + 1
            starts = np.concatenate([[0], change])
            ends = np.concatenate([change, [len(bits)]])
            sizes = ends - starts
            inner = np.ones(len(starts), dtype=bool)
            inner[0] = inner[-1] = False  # these may go on in another batch
            group = np.repeat(np.arange(len(starts)), sizes)
            simple = np.repeat(inner & (sizes > 1) & (sizes <= small), sizes)
            for shift in range(1, small):
                pair = simple[:-shift] & (group[:-shift] == group[shift:])
                at = np.flatnonzero(pair)
                if not at.size:
                    break
                at = at[_near(bits[at], bits[at + shift], max_bits)]
                yield batch(bits[at], bits[at + shift])
            for g in np.flatnonzero(~inner | (sizes > small)).tolist():
                here = (int(c[starts[g]]), int(cell[starts[g]]))
                if here != key:
                    if len(held) > 1 or chunks:
                        yield from resolved(last=True)
                    key, held, chunks = here, np.zeros(0, dtype=np.uint64), 0
                held = np.concatenate([held, bits[starts[g] : ends[g]]])
                while len(held) > CHUNK:
                    rest, held = held[CHUNK:], held[:CHUNK]
                    yield from resolved(last=False)
                    held = rest
        if len(held) > 1 or chunks:
            yield from resolved(last=True)

    return run


def _links_in_tiles(max_bits: int):
    """The same over rows sorted by tile: a tile holds two chunks of a large cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def resolved():
            a, b = local_components(np.unique(np.concatenate(held)), max_bits)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
            )

        for rows in batches:
            keys = np.column_stack(
                [rows.column(k).to_numpy() for k in ("c", "cell", "low", "high")]
            )
            bits = rows.column("a").to_numpy().view(np.uint64)
            cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
            for part in np.split(np.arange(len(bits)), cuts):
                if not part.size:
                    continue
                here = tuple(keys[part[0]].tolist())
                if here != key and held:
                    yield resolved()
                    held = []
                key = here
                held.append(bits[part])
        if held:
            yield resolved()

    return run


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links that join every two fingerprints within ``max_bits`` bits, directly or over
    others that are linked themselves. ``prints`` has distinct fingerprints in column ``a``.

    A cell of any size is handled in chunks of bounded memory; chunks of one cell meet in tiles
    of two, each a task's own group.
    """
    if max_bits > MAX_BITS:
        raise ValueError(f"the grid of {BLOCKS} blocks serves up to {MAX_BITS} bits")
    cells = _cells(prints).repartition("c", "cell").sortWithinPartitions("c", "cell")
    first = stored(cells.mapInArrow(_links_in_cells(max_bits), _LINKS), "simhash-cells")
    links = first.where("b is not null").select("a", "b")
    open_rows = first.where("b is null")
    chunks = open_rows.groupBy("c", "cell").agg(F.max("chunk").alias("last"))
    others = F.filter(F.sequence(F.lit(0), F.col("last")), lambda k: k != F.col("chunk"))
    tiles = (
        open_rows.select("c", "cell", "chunk", "a")
        .join(chunks, ["c", "cell"])
        .select("c", "cell", "a", "chunk", F.explode(others).alias("other"))
        .select(
            "c",
            "cell",
            F.least("chunk", "other").alias("low"),
            F.greatest("chunk", "other").alias("high"),
            "a",
        )
        .repartition("c", "cell", "low", "high")
        .sortWithinPartitions("c", "cell", "low", "high")
    )
    return links.union(tiles.mapInArrow(_links_in_tiles(max_bits), "a long, b long"))


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """Per row of ``docs``: (id, text_hash, simhash, group, component_id), in no order.

    Rows are linked if their fingerprints differ in ``max_bits`` bits or fewer; component_id is
    the smallest id reachable over links, itself included. Only distinct fingerprints enter the
    join, so exact copies cost one row. Null texts and texts without words have fingerprint zero
    and are linked like any other. A null id is never a component_id unless its whole component
    has no other; repeated rows are each reported. ``group`` is the smallest fingerprint (as a
    signed number) of the component, text_hash tells rows with the same id apart. An empty table
    gives no rows; only the two named columns are read.
    """
    named = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).alias("text"),
    )
    prints = stored(
        map_rows(
            named,
            f"id {docs.schema[id_col].dataType.simpleString()}, text_hash long, a long",
            ["id", "text_hash", "text"],
            lambda _, key, version, text: (key, version, fingerprint(text, shingle_words)),
        ),
        "simhash-prints",
    )
    distinct = prints.groupBy("a").agg(F.min("id").alias("low"))
    member = connected(near_links(distinct.select("a"), max_bits))
    member = member.withColumnRenamed("node", "a")
    rooted = distinct.join(member, "a", "left").select(
        "a", "low", F.coalesce("root", "a").alias("group")
    )
    lowest = rooted.groupBy("group").agg(F.min("low").alias("component_id"))
    classes = rooted.join(lowest, "group").select("a", "group", "component_id")
    return prints.join(classes, "a").select(
        F.col("id").alias(id_col), "text_hash", F.col("a").alias("simhash"), "group", "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id (null ids last).

    All columns stay. Among rows that repeat that id, the smaller text hash stays, and one row of
    those that repeat the text too.
    """
    groups = simhash_groups(docs, id_col, text_col, shingle_words, max_bits)
    first = F.min(F.struct(F.col(id_col).isNull(), F.col(id_col).alias("id"), "text_hash"))
    kept = groups.groupBy("group").agg(first.alias("first"))
    kept = kept.select(F.col("first.id").alias("_id"), F.col("first.text_hash").alias("_hash"))
    marked = docs.withColumn("__orderlake_text_hash", F.xxhash64(text_col))
    same = marked[id_col].eqNullSafe(kept["_id"]) & (marked["__orderlake_text_hash"] == kept["_hash"])
    survivors = marked.join(kept, same, "left_semi")
    return survivors.dropDuplicates([id_col, "__orderlake_text_hash"]).drop("__orderlake_text_hash")
