import random
from collections import Counter

import numpy as np
import pytest

from orderlake.llm import substrings
from llm_cases import awkward, no_docs  # noqa: F401


def brute(rows, window=13):
    first = {}
    split = [(k, (t or "").encode().split()) for k, t in rows]
    for key, w in split:
        if key is not None:
            for i in range(len(w) - window + 1):
                run = tuple(w[i : i + window])
                first[run] = min(first.get(run, key), key)
    found = []
    for key, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if key is not None and first[tuple(w[i : i + window])] < key:
                gone |= set(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        found.append((key, len(w), len(gone), kept))
    return Counter(found)


def result(frame):
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in frame.collect())


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(2)
    make = lambda n: " ".join(draw.choice("abcdefgh") * draw.randint(1, 3) for _ in range(n))  # noqa: E731,E501
    passages = [make(n) for n in (12, 13, 14, 20, 51, 80)]
    found = []
    for key in range(120):
        parts = [make(draw.randint(0, 25))]
        for _ in range(draw.randint(0, 3)):
            parts += [draw.choice(passages), make(draw.randint(0, 9))]
        found.append((draw.choice([key, 7]), draw.choice([" ", "\n", "\t "]).join(parts)))
    return found + [(500, "x " * 400), (499, "x " * 300), (501, found[0][1]), (None, found[1][1])]


def test_like_brute_force(spark, rows):
    docs = spark.createDataFrame(
        [(*r, "clash", "clash") for r in rows], "doc_id long, text string, id string, starts string"
    )
    assert result(substrings.drop_repeats(docs)) == brute(rows)


def test_a_full_filter_changes_nothing(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(substrings.drop_repeats(docs, filter_bits=15)) == brute(rows)


def test_awkward_rows(awkward, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert result(substrings.drop_repeats(awkward)) == brute(rows)
    assert substrings.drop_repeats(no_docs).count() == 0


def test_every_pair_of_offsets_shares_an_aligned_anchor():
    cover = set(substrings.COVER)
    for i in range(substrings.PERIOD):
        for j in range(substrings.PERIOD):
            assert any(
                (i + d) % substrings.PERIOD in cover and (j + d) % substrings.PERIOD in cover
                for d in range(substrings.PERIOD)
            )


def test_rolling_hashes_depend_on_the_run_alone():
    words = [b"a", b"b", b"c", b"d"] * 6
    hashes = substrings._rolling(substrings._word_hashes(words)[:, 0], 5, 0x9E3779B97F4A7C15)
    assert len(hashes) == 20 and len(np.unique(hashes)) == 4
    assert (hashes[:16] == hashes[4:]).all()
