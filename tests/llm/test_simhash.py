import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from orderlake.llm import common, simhash
from orderlake.llm.common import connected
from llm_cases import awkward, no_docs  # noqa: F401

TABLE = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    size = min(4, len(words))
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42)
        for i in range(len(words) - size + 1)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def slow_groups(rows):
    prints = [(i, slow_fingerprint(t)) for i, t in rows]
    links = [
        (i, j)
        for i in range(len(prints))
        for j in range(i)
        if (prints[i][1] ^ prints[j][1]).bit_count() <= 4
    ]
    member = slow_components(range(len(prints)), links)
    lowest = defaultdict(list)
    for at, (key, _) in enumerate(prints):
        lowest[member[at]].append(key)
    low = {m: min((k for k in ids if k is not None), default=None) for m, ids in lowest.items()}
    return Counter((k, f, low[member[at]]) for at, (k, f) in enumerate(prints))


def found_groups(frame):
    return Counter(
        (r["doc_id"], r["simhash"] & (1 << 64) - 1, r["component_id"]) for r in frame.collect()
    )


def test_documents_like_brute_force(spark):
    docs = spark.read.parquet(f"{TABLE}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found_groups(simhash.simhash_groups(docs)) == slow_groups(rows)


def test_awkward_rows(awkward, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert found_groups(simhash.simhash_groups(awkward)) == slow_groups(rows)
    assert simhash.simhash_groups(no_docs).count() == 0


@pytest.mark.parametrize("chunk", [16, 50, 4096])
def test_links_join_what_is_near_whatever_the_chunks(spark, monkeypatch, chunk):
    """Tight clusters far larger than a chunk, random prints, and chains of four bits a step."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    draw = random.Random(3)
    prints = {draw.getrandbits(64) for _ in range(400)} | {0, (1 << 64) - 1}
    centre = draw.getrandbits(64)
    prints |= {centre ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)}
    step = draw.getrandbits(64)
    for k in range(12):
        step ^= 0b1111 << 5 * k
        prints.add(step)
    prints = sorted(prints)
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "a long")
    links = simhash.near_links(frame)
    root = {r["node"]: r["root"] for r in connected(links).collect()}
    near = [
        (a, b)
        for i, a in enumerate(prints)
        for b in prints[:i]
        if (a ^ b).bit_count() <= 4
    ]
    classes, wanted = defaultdict(set), defaultdict(set)
    for p, c in slow_components(prints, near).items():
        wanted[c].add(p)
    for p, s in zip(prints, signed, strict=True):
        classes[root.get(s, s)].add(p)
    assert set(map(frozenset, classes.values())) == set(map(frozenset, wanted.values()))
    assert links.count() <= 35 * len(prints) * 8


def test_manhattan_distance_never_exceeds_hamming():
    bits = np.random.default_rng(1).integers(0, 2**63, 2000, dtype=np.uint64)
    other = np.random.default_rng(2).integers(0, 2**63, 2000, dtype=np.uint64)
    coded = np.bitwise_count(simhash.unary_counts(bits) ^ simhash.unary_counts(other))
    segments = lambda x: np.stack([np.bitwise_count(x >> np.uint64(s) & np.uint64(3)) for s in range(0, 64, 2)])  # noqa: E731,E501
    manhattan = np.abs(segments(bits).astype(int) - segments(other).astype(int)).sum(axis=0)
    assert (coded == manhattan).all()
    assert (manhattan <= np.bitwise_count(bits ^ other)).all()


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, k) for k in range(1001, 1200)] + [(5, 5)]
    found = connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {
        **{i: 0 for i in range(1, 61)},
        **{k: 1000 for k in range(1001, 1200)},
    }


def test_one_row_of_each_group_stays(awkward, spark):
    kept = simhash.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    rows = kept.select("doc_id", "text").collect()
    ids = [r["doc_id"] for r in rows]
    # 1, 2, 3 and the null text have fingerprint zero; 5 and 6 are copies; 7 is repeated
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 7, 8]
    assert ids.count(None) <= 1


def test_few_links_are_kept_in_few_files(spark, conf):
    """Each file costs three processes where the file system is local: rounds over a few links took
    as many files as the shuffle has parts."""
    conf(spark__sql__shuffle__partitions="40", spark__sql__adaptive__coalescePartitions__enabled="false")
    edges = [(k, k + 1) for k in range(0, 400) if k % 100 != 99]
    frame = spark.createDataFrame(edges, "a long, b long")
    for known in ((), (len(edges),)):
        found = connected(frame, *known)
        assert len(found.inputFiles()) == 1
        assert {r["node"]: r["root"] for r in found.collect()} == {
            k: k // 100 * 100 for k in range(401) if k % 100
        }


def test_many_links_stay_as_they_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(common, "_FILE_ROWS", 100)
    frame = spark.range(1000).repartition(8)
    assert common.in_parts(frame, 1000).rdd.getNumPartitions() == 8
    assert common.in_parts(frame, 250).rdd.getNumPartitions() == 3
    assert common.in_parts(frame, 0).rdd.getNumPartitions() == 1
