import itertools
import random

import pytest

from orderlake.llm import packing
from llm_cases import awkward, no_docs  # noqa: F401


def padding(lengths, counts, cuts):
    total, at = 0, 0
    for size, n in zip(lengths, counts, strict=True):
        while size > cuts[at]:
            at += 1
        total += n * (cuts[at] - size)
    return total


@pytest.mark.parametrize("seed", range(8))
def test_boundaries_are_optimal(seed):
    draw = random.Random(seed)
    lengths = sorted(draw.sample(range(0, 60), 9))
    counts = [draw.randint(1, 9) for _ in lengths]
    for buckets in (1, 2, 3, 4, 12):
        cuts = packing.best_boundaries(lengths, counts, buckets)
        assert cuts[-1] == lengths[-1] and len(cuts) <= buckets
        best = min(
            padding(lengths, counts, [*c, lengths[-1]])
            for c in itertools.combinations(lengths[:-1], min(buckets, len(lengths)) - 1)
        )
        assert padding(lengths, counts, cuts) == best


def test_pieces_cover_every_text_and_batches_keep_the_budget(awkward):
    packed = packing.pack(awkward, max_tokens=500, buckets=4, token_budget=2000, slices=4)
    rows = packed.rows.collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append((r["first_token"], r["n_tokens"]))
    assert sorted(pieces[5]) == [(k * 500, 500) for k in range(120)]
    assert pieces[1] == pieces[2] == pieces[3] == [(0, 0)] and pieces[4] == [(0, 1)]
    assert pieces[7] == [(0, 17)] * 2 and len(pieces[None]) == 2
    batches = {}
    for r in rows:
        assert r["n_tokens"] <= r["boundary"] == packed.boundaries[r["bucket"]]
        batches.setdefault((r["bucket"], r["batch"]), []).append(r)
    for members in batches.values():
        assert len(members) * max(1, members[0]["boundary"]) <= 2000
        assert sorted(m["slot"] for m in members) == list(range(len(members)))


def test_no_rows(no_docs):
    packed = packing.pack(no_docs)
    assert packed.boundaries == [] and packed.rows.count() == 0
    assert "boundary" in packed.rows.columns
