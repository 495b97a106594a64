import random
import re
from collections import Counter

import pytest

from conftest import plan_of
from orderlake.llm import decontam
from llm_cases import awkward, no_docs  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(13, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    found = []
    for key, text in docs:
        w, hit, names = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if seen := windows.get(tuple(w[i : i + size])):
                    hit |= set(range(i, i + size))
                    names |= {str(n) for n in seen if n is not None}
        found.append((key, len(w), len(hit), tuple(sorted(names)), 20 * len(hit) >= len(w) > 0 < len(hit)))
    return Counter(found)


def result(frame):
    return Counter(
        (r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"]), r["contaminated"])
        for r in frame.collect()
    )


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "ÜBER", "MiX", "naïve"]
    make = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    items = [(i, make(draw.choice([0, 1, 2, 5, 13, 14, 30]))) for i in range(25)]
    items += [(100, None), (101, ""), (None, make(20)), (3, items[3][1]), (102, items[5][1])]
    docs = [(i, make(40)) for i in range(30)]
    for i in range(30, 60):
        parts = [make(draw.randint(0, 30)), draw.choice(items)[1] or "", make(draw.randint(0, 200))]
        docs.append((i, draw.choice([" ", "\n", "-"]).join(parts).swapcase()))
    docs += [(60, None), (61, ""), (62, "!?"), (30, docs[30][1]), (30, docs[30][1]), (None, docs[31][1])]
    return docs, items


def test_like_brute_force(spark, tables):
    docs, items = tables
    d = spark.createDataFrame(
        [(*r, "clash", "clash") for r in docs],
        "doc_id long, text string, prefix string, words string",
    )
    b = spark.createDataFrame(items, "item_id long, text string")
    for slots in (1 << 17, 8):  # a full filter only costs time
        assert result(decontam.decontaminate(d, b, slots=slots)) == brute(docs, items)


def test_awkward_and_empty_tables(awkward, no_docs, spark, tables):
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    items = [(1, "the lazy dog"), (2, "word5 word6 word7"), (3, "Ünïcode ÄÖÜ")]
    b = spark.createDataFrame(items, "item_id int, text string")
    assert result(decontam.decontaminate(awkward, b)) == brute(docs, items)
    assert result(decontam.decontaminate(awkward, b.where("false"))) == brute(docs, [])
    assert decontam.decontaminate(no_docs, b).count() == 0


def test_contaminated_rows_go_and_columns_stay(awkward, spark):
    b = spark.createDataFrame([(1, "the lazy dog")], "item_id int, text string")
    kept = decontam.drop_contaminated(awkward, b)
    assert kept.columns == awkward.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "6", "8", "None"]


def test_no_python_in_the_plan(awkward, spark):
    b = spark.createDataFrame([(1, "the lazy dog")], "item_id int, text string")
    plan = plan_of(decontam.decontaminate(awkward, b))
    assert not re.search("Python|Pandas|Arrow", plan)
