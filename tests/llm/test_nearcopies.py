import random

import corpus_pipeline
import pytest
from llm_cases import awkward, no_docs  # noqa: F401
from orderlake.llm import nearcopies, simhash
from test_simhash import slow_components


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def planted():
    """Copies of 60 to 400 words with a few changed words, at similarities from 0.7 to 0.97; a
    large group of copies of one text; texts that share one long passage and nothing else."""
    draw = random.Random(6)
    make = lambda n: [f"w{draw.randint(0, 5000)}" for _ in range(n)]
    rows = []
    for _ in range(150):
        words = make(draw.randint(60, 400))
        copy = list(words)
        for at in draw.sample(range(len(words)), max(1, round(len(words) * draw.uniform(0.003, 0.03)))):
            copy[at] = "changed"
        rows += [words, copy]
    centre = make(120)
    for _ in range(80):
        copy = list(centre)
        for _ in range(2):
            copy[draw.randrange(120)] = f"c{draw.randint(0, 5000)}"
        rows.append(copy)
    passage = make(60)
    rows += [passage + make(40) for _ in range(60)]
    draw.shuffle(rows)
    return [(k, " ".join(words)) for k, words in enumerate(rows)]


@pytest.mark.parametrize("tile_shingles", [nearcopies.TILE_SHINGLES, 2500])
def test_stage_keeps_one_of_planted_copies(spark, monkeypatch, tile_shingles):
    monkeypatch.setattr(nearcopies, "TILE_SHINGLES", tile_shingles)
    rows = planted()
    held = [nearcopies.shingles(text.encode()) for _, text in rows]
    near = [(i, j) for i in range(len(held)) for j in range(i) if jaccard(held[i], held[j]) >= 0.8]
    assert sum(jaccard(held[i], held[j]) < 0.95 for i, j in near) > 100
    member = slow_components(range(len(rows)), near)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert {r["doc_id"] for r in kept.collect()} == set(member.values())


@pytest.mark.parametrize("crosswise", [False, True])
def test_joining_pairs_join_what_all_pairs_join(crosswise):
    draw = random.Random(8)
    for _ in range(60):
        centre = [draw.randint(0, 99) for _ in range(draw.randint(1, 40))]
        members = []
        for node in range(draw.randint(2, 25)):
            held = {x if draw.random() > 0.08 else draw.randint(100, 120) for x in centre}
            members.append((node, draw.choice([node, 3]), draw.randint(0, 1), {b"%d" % x for x in held}))
        pairs = [
            (a[1], b[1])
            for i, a in enumerate(members)
            for b in members[:i]
            if jaccard(a[3], b[3]) >= 0.8 and not (crosswise and a[2] == b[2])
        ]
        found = list(nearcopies.joining_pairs(members, crosswise, 0.8))
        assert all(jaccard(members[a][3], members[b][3]) >= 0.8 for a, b in found)
        roots = {m[1] for m in members}
        linked = [(members[a][1], members[b][1]) for a, b in found]
        assert slow_components(roots, linked) == slow_components(roots, pairs)
        assert len(linked) == len(roots) - len(set(slow_components(roots, linked).values()))


def test_awkward_rows(awkward, no_docs):  # noqa: F811
    kept = nearcopies.drop_near_copies(awkward)
    assert kept.schema == awkward.schema
    ids = [r["doc_id"] for r in kept.collect()]
    # 1, 2, 3 and the null text have no shingles; 5 and 6 are copies; 7 is repeated
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 7, 8]
    assert nearcopies.drop_near_copies(no_docs).count() == 0


def test_stage_groups_by_simhash_first(spark, monkeypatch):
    """Without MinHash cells, exactly the groups that SimHash links and the exact check confirms."""
    rows = planted() + [(2000, "one two"), (2001, "one  two"), (2002, ""), (2003, None)]
    monkeypatch.setattr(nearcopies, "cells", lambda held: [])
    held = [nearcopies.shingles((text or "").encode()) for _, text in rows]
    prints = [simhash.fingerprint((text or "").encode(), 5) for _, text in rows]
    near = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if ((prints[i] ^ prints[j]) & (1 << 64) - 1).bit_count() <= 4
    ]
    assert len(near) > 15
    assert all(jaccard(held[i], held[j]) >= 0.8 for i, j in near)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    member = slow_components(range(len(rows)), near)
    assert {r["doc_id"] for r in kept.collect()} == {rows[k][0] for k in set(member.values())}


def test_simhash_pairs_below_the_similarity_stay_apart(spark):
    """Fingerprints of shingles that hardly count may agree where the sets do not."""
    text = "a b c d e " * 40
    rows = [(1, text + "f"), (2, text + "g h i j"), (3, "q r")]
    kept = nearcopies.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 3}
