import random

from llm_cases import awkward, no_docs  # noqa: F401
from orderlake.llm import linerules
from pyspark.sql import functions as F


def repeated(words, window=8):
    places = {}
    for i in range(len(words) - window + 1):
        places.setdefault(tuple(words[i : i + window]), []).append(i)
    return len({i + k for at in places.values() if len(at) > 1 for i in at for k in range(window)})


def test_repeated_words_like_brute_force(spark):
    draw = random.Random(4)
    rows = []
    for key in range(300):
        words = [str(draw.randrange(draw.choice([1, 2, 50]))) for _ in range(draw.randint(0, 60))]
        for _ in range(draw.randint(0, 2)):
            at = draw.randint(0, len(words))
            words[at:at] = words[: draw.randint(0, 30)]
        rows.append((key, words))
    frame = spark.createDataFrame(rows, "id long, w array<string>")
    for window in (8, 5, 1):
        found = frame.select("id", linerules.repeated_words(F.col("w"), window).alias("n")).collect()
        assert {r["id"]: r["n"] for r in found} == {k: repeated(w, window) for k, w in rows}


def test_rules(spark):
    lines = {
        "The committee met on Monday and agreed to nothing.": None,
        "«Nous verrons demain.»": None,
        "Is it so? (It is!)": None,
        "": None,
        "Home | Products | About | Contact": "navigation",
        "Home » About us » Contact": "navigation",
        "Next page": "navigation",
        "Home is where the menu is, they said.": None,
        "We use cookies to improve your experience.": "boilerplate",
        "© 2020 Example. All Rights Reserved.": "boilerplate",
        "We use cookies " + "and say so at length " * 20 + "in prose.": None,
        "A line that stops in the middle of": "punctuation",
        "WORDS!! THAT!! ARE!! SHOUTED!!": "punctuation",
        "odd*** odd&&& odd$$$ odd### end.": "punctuation",
        "a | b.": None,
    }
    frame = spark.createDataFrame([(line,) for line in lines], "line string")
    found = frame.select("line", linerules.failed_rule(F.col("line")).alias("rule")).collect()
    assert {r["line"]: r["rule"] for r in found} == lines


def test_document_by_what_is_left(spark):
    good = "This sentence has exactly seven words here. " * 2 + "It differs in its second half. "
    prose = "\n".join(f"Sentence number {k} of this text says something else again {k * 7}." for k in range(6))
    menu = "\n".join(f"Item {k} | Item {k}a | Item {k}b | Item {k}c" for k in range(30))
    rows = [(1, prose), (2, f"{menu}\n{prose}"), (3, "Short."), (4, (good + "\n") * 5), (5, f"Home | A | B | C\n{prose}")]
    found = linerules.clean_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    rows = {r["doc_id"]: r for r in found}
    assert [rows[k]["kept"] for k in range(1, 6)] == [True, False, False, False, True]
    assert [rows[k]["base_failed"] for k in range(1, 6)] == [False, False, True, True, False]
    assert rows[2]["n_navigation"] == 30 and rows[4]["n_dup_lines"] == 4
    assert rows[5]["cleaned"] == prose
    kept = linerules.keep_clean(spark.createDataFrame([(5, f"Home | A | B | C\n{prose}")], "doc_id long, text string"))
    assert [tuple(r) for r in kept.collect()] == [(5, prose)]


def test_only_built_in_functions(awkward):  # noqa: F811
    plan = linerules.clean_lines(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_awkward_rows(awkward, no_docs):  # noqa: F811
    found = linerules.clean_lines(awkward).collect()
    assert len(found) == awkward.count()
    assert all(r["n_words"] == 0 and not r["kept"] and r["cleaned"] == "" for r in found if r["doc_id"] in (1, 2, 3))
    long = [r for r in found if r["doc_id"] == 5][0]
    assert long["n_words"] == 60_000 == long["n_repeat_words"] and long["base_failed"]
    assert linerules.clean_lines(no_docs).count() == 0
