import hashlib
import random
import zlib

import pytest
from llm_cases import awkward, no_docs  # noqa: F401
from orderlake.llm import queries, runs

SF_DIR = "/root/testdata/sf0.001"


def brute(words, min_length=6, min_periods=4):
    """Every period in turn, smallest first: a stretch seen with a smaller period is that run."""
    seen = {}
    for q in range(1, len(words) // min_periods + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            if end > at and length >= max(min_length, min_periods * q):
                seen.setdefault((at, length), q)
            at = max(end, at + 1)
    return sorted((at, length, q) for (at, length), q in seen.items())


@pytest.mark.parametrize("min_length,min_periods", [(6, 4), (4, 4), (9, 3), (6, 5), (30, 4)])
def test_like_brute_force(min_length, min_periods):
    draw = random.Random(min_length)
    for _ in range(600):
        alphabet = draw.choice([1, 2, 3, 5])
        words = [b"%d" % draw.randrange(alphabet) for _ in range(draw.randint(0, 60))]
        for _ in range(draw.randint(0, 3) if words else 0):
            at, period = draw.randrange(len(words)), draw.randint(1, 6)
            block = words[at : at + period]
            words[at:at] = (block * 40)[: draw.randint(1, 40)]
        assert runs.runs_of(words, min_length, min_periods) == brute(words, min_length, min_periods)


def test_pairs_are_maximal_and_their_multiples_fall_to_one_run():
    words = [b"x"] + [b"a", b"b"] * 10 + [b"y"]
    pairs = list(runs.maximal_pairs(runs.np.array([int.from_bytes(w) for w in words]), 6, 4))
    assert sorted((j - i, n) for i, j, n in pairs) == [(2, 18), (4, 16)]
    assert runs.runs_of(words) == [(1, 20, 2)]


def test_long_texts_take_no_square_of_their_length():
    words = [b"%d" % (k % 20) for k in range(100_000)]
    assert runs.runs_of(words) == [(0, 100_000, 20)]
    assert runs.runs_of([b"the"] * 100_000) == [(0, 100_000, 1)]


def test_suffix_order():
    draw = random.Random(2)
    for _ in range(100):
        ids = [draw.randrange(3) for _ in range(draw.randint(1, 40))]
        order, shared = runs.suffix_order(runs.np.array(ids))
        assert order.tolist() == sorted(range(len(ids)), key=lambda i: ids[i:])
        for k in range(1, len(ids)):
            one, other = ids[order[k - 1] :], ids[order[k] :]
            n = 0
            while n < min(len(one), len(other)) and one[n] == other[n]:
                n += 1
            assert shared[k] == n


def test_awkward_rows(awkward, no_docs):  # noqa: F811
    found = runs.find_runs(awkward)
    rows = found.collect()
    assert len(rows) == awkward.count()
    kept = {(r["doc_id"], r["n_words"]): r for r in rows}
    assert kept[1, 0]["collapsed"] == "" and kept[1, 0]["runs"] == []
    # the long text has its words in cycles of 977
    assert [tuple(run) for run in kept[5, 60_000]["runs"]] == [(0, 60_000, 977)]
    assert len(kept[5, 60_000]["collapsed"].split()) == 977
    assert runs.find_runs(no_docs).count() == 0


def slow_row(key, text):
    words = (text or "").encode().split()
    draw, n = zlib.crc32(str(key).encode()), len(words)
    if draw % 10 == 0 and n:
        a, g = draw // 10 % n, draw // 10
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    longest = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    return (
        key,
        len(found),
        *(longest or (None, None, None)),
        longest and 1000 * longest[1] // longest[2],
        sha("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()),
        sha(b" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_like_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = queries.op13_periodic_runs(spark, SF_DIR).collect()
    assert sum(r["n_runs"] > 0 for r in found) > 10
    assert sorted(map(tuple, found)) == sorted(slow_row(*row) for row in docs)
