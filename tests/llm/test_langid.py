import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import awkward, no_docs  # noqa: F401
from orderlake.llm import langid

PARTS = {
    "xa": ["lor", "em", "ip", "sum", "dol"],
    "xb": ["zak", "wij", "oke", "vuu", "hij"],
    "xc": ["ñan", "cho", "illa", "ado", "rrí"],
}


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(6)
    rows = []
    for k in range(600):
        lang = draw.choice(list(PARTS))
        words = ["".join(draw.choices(PARTS[lang], k=draw.randint(1, 3))) for _ in range(12)]
        rows.append((k, " ".join(words), None if k % 41 == 0 else lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy_and_calibration(docs):
    model = langid.train(langid.learnable(docs))
    assert model["languages"] == ["xa", "xb", "xc"] and 0.01 < model["temperature"] < 20
    judged = langid.identify(docs, model).join(docs, "doc_id").where(langid.is_held_out())
    judged = judged.where("lang is not null")
    right = judged.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    assert judged.where("score < 0 or score > 1").count() == 0


def test_the_id_alone_decides_what_is_learned(docs):
    ids = [r["doc_id"] for r in langid.learnable(docs).collect()]
    from zlib import crc32

    assert sorted(ids) == [k for k in range(600) if crc32(str(k).encode()) % 5 != 0]


def test_penalties_leave_most_weights_at_zero(docs):
    weights = langid.train(langid.learnable(docs))["weights"]
    assert 0 < np.count_nonzero(weights) < 0.1 * weights.size


def test_the_temperature_minimises_log_loss():
    draw = np.random.default_rng(0)
    labels = draw.integers(0, 3, 4000)
    logits = draw.normal(size=(4000, 3)) + 2.0 * np.eye(3)[labels]
    assert langid.temperature(logits * 5, labels) == pytest.approx(
        5 * langid.temperature(logits, labels), rel=1e-3
    )
    assert langid.temperature(np.zeros((0, 3)), labels[:0]) == 1.0


def test_awkward_rows(awkward, no_docs, docs):  # noqa: F811
    model = langid.train(docs)
    found = {}
    for r in langid.identify(awkward, model).collect():
        found.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert found[1] == found[2] == found[3] == [("und", 0.0)]
    assert len(found[7]) == 2 and found[8][0][0] in PARTS
    assert langid.identify(no_docs, model).count() == 0
    assert langid.train(no_docs) is None
    assert {r["lang_pred"] for r in langid.identify(awkward, None).collect()} == {"und"}
    assert langid.identify(awkward, langid.train(awkward)).count() == awkward.count()
