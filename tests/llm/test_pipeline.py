import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from llm_cases import awkward, no_docs  # noqa: F401
from orderlake.llm import nearcopies, packing, pii, toxicity
from orderlake.llm.common import stored, table
from test_decontam import brute as contaminated
from test_simhash import slow_components

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = table(spark, SF_DIR, "documents")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(stored(stage(spark, found[-1], SF_DIR), "test-stage"))
    return [{r[0]: r for r in frame.collect()} if k < 5 else frame.collect() for k, frame in enumerate(found)], found


def test_stages_keep_the_columns_of_documents(steps):
    _, frames = steps
    for frame in frames[1:-1]:
        assert frame.schema == frames[0].schema


def test_toxicity_drops_what_scores_high(spark, steps):
    rows, frames = steps
    labels = toxicity.learnable(table(spark, SF_DIR, "labels"))
    scores = toxicity.score(frames[0], toxicity.train(frames[0], labels)).collect()
    assert set(rows[1]) == {r["doc_id"] for r in scores if r["score"] < toxicity.THRESHOLD}


def test_one_document_of_each_group_stays(steps):
    """Groups are what links of similarity 0.8 on five-word shingles reach, all pairs compared."""
    rows, _ = steps
    held = [(key, nearcopies.shingles((r["text"] or "").encode())) for key, r in rows[1].items()]
    near = [
        (a, b) for i, (a, one) in enumerate(held) for b, other in held[:i] if nearcopies.similar(one, other)
    ]
    assert len(near) > 10
    assert set(rows[2]) == set(slow_components(rows[1], near).values())


def test_contaminated_documents_go(spark, steps):
    rows, _ = steps
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_DIR, "benchmark").collect()]
    judged = contaminated([(k, r["text"]) for k, r in rows[2].items()], items)
    assert set(rows[3]) == {key for key, *_, bad in judged if not bad}


def test_personal_data_is_masked(steps):
    rows, _ = steps
    assert set(rows[4]) == set(rows[3])
    assert any("<EMAIL>" in (r["text"] or "") for r in rows[4].values())
    for key, row in rows[4].items():
        assert row["n_chars"] == len(row["text"])
        fixed = pii.fixed_spans(rows[3][key]["text"])
        assert not [s for s in pii.fixed_spans(row["text"]) if fixed and s[2] == "email"]


def test_every_word_is_packed(steps):
    rows, _ = steps
    tokens = {}
    for r in rows[5]:
        tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["n_tokens"]
        assert r["n_tokens"] <= r["boundary"] <= packing.MAX_TOKENS
    assert tokens == {k: len(r["text"].split()) for k, r in rows[4].items()}


def test_run_is_the_stages_in_order(spark, steps):
    rows, _ = steps
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == sorted(map(tuple, rows[5]))
    assert "pipeline" in entry_point.queries()


def test_awkward_rows_pass_every_stage(spark, awkward, no_docs):  # noqa: F811
    for docs in (awkward, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF_DIR), "test-stage")
        docs.count()
