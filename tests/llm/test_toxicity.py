import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import awkward, no_docs  # noqa: F401
from orderlake.llm import toxicity

RUDE = ["idiot", "moron", "stupid", "worthless"]
LEET = str.maketrans("oiesa", "01354")


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(8)
    parts = ["lo", "ra", "mi", "ten", "dos", "ver", "pli", "co", "una", "est"]
    make = lambda n: " ".join("".join(draw.choices(parts, k=draw.randint(1, 3))) for _ in range(n))  # noqa: E731,E501
    rows, labels = [], []
    for k in range(900):
        toxic = k % 6 == 0
        words = make(25).split()
        if toxic:
            rude = draw.choice(RUDE)
            if k % 4 == 0:
                rude = draw.choice([rude.translate(LEET), " ".join(rude), rude.replace(rude[2], rude[2] * 4), rude.upper() + "!!"])
            words.insert(draw.randint(0, 25), rude)
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


@pytest.fixture(scope="module")
def model(tables):
    docs, labels = tables
    return toxicity.train(docs, toxicity.learnable(labels))


def test_held_out_recall_and_precision(tables, model):
    docs, labels = tables
    judged = toxicity.score(docs, model).join(labels, "doc_id").where(toxicity.is_held_out())
    said = F.col("score") >= toxicity.THRESHOLD
    counts = judged.groupBy("toxic", said.alias("said")).count().collect()
    n = {(r["toxic"], r["said"]): r["count"] for r in counts}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.9
    assert n.get((0, True), 0) / n[0, False] < 0.02


@pytest.mark.parametrize(
    "text, word",
    [
        ("you 1d10t", "idiot"),
        ("a m0r0n.", "moron"),
        ("i d i o t", "idiot"),
        ('say "i d i o t" now', "idiot"),
        ("what an id iot.", "idiot"),
        ("what an 1d iot.", "idiot"),
        ("id.iot", "idiot"),
        ("i-diot", "idiot"),
        ("you st-up-id", "stupid"),
        ("s.t.u.p.i.d", "stupid"),
        ("stuuuupiiid", "stupid"),
        ("w0rthl3$$", "worthless"),
        ("MORON!!! ***", "moron"),
        ("what a m o r o n, really", "moron"),
        ("idiiot", "idiot"),
        ("an idi\u043et", "idiot"),
        ("a \u043c\u043er\u043en!", "moron"),
    ],
)
def test_obfuscated_words_come_back(model, text, word):
    letters = toxicity.LetterModel(model["counts"])
    assert word in toxicity.Restorer(letters, tuple(model["lexicon"])).words(text.encode())


def test_viterbi_finds_the_cheapest_reading(model):
    letters = toxicity.LetterModel(model["counts"])

    def price(steps):
        total, a, b = 0.0, 0, 0
        for text, cost in steps:
            total += cost
            for letter in text:
                code = 0 if letter == " " else ord(letter) - 96
                total += letters.cost[a][b][code]
                a, b = (0, 0) if code == 0 else (b, code)
        return total + letters.cost[a][b][0]

    for token in ("1d10t", "m**on", "lllo55", "!a$$1"):
        runs = toxicity._runs(token)
        last = len(runs) - 1
        lattice = [toxicity._symbol(m, n, 0 < k < last) for k, (m, n) in enumerate(runs)]
        best = min(itertools.product(*lattice), key=price)
        assert toxicity.decode_token(letters, token) == "".join(text for text, _ in best)


def test_letter_counts_are_those_of_all_texts(tables):
    docs, _ = tables
    counts = toxicity.letter_counts(docs)
    wanted = np.zeros(27**3, dtype=np.int64)
    for row in docs.collect():
        for word in "".join(c if c in toxicity._LETTERS else " " for c in row["text"].lower()).split():
            codes = [0, 0, *(ord(c) - 96 for c in word), 0]
            for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
                wanted[a * 729 + b * 27 + c] += 1
    assert (counts == wanted).all()


def test_words_in_other_alphabets_are_learned(spark):
    draw = random.Random(3)
    good = ["дом", "река", "письмо", "поле", "книга", "世界", "你好", "天气"]
    rows = []
    for k in range(400):
        words = draw.choices(good, k=6) + (["дурак" if k % 8 else "蠢货们"] if k % 4 == 0 else [])
        draw.shuffle(words)
        rows.append((k, " ".join(words) + f" {k}", int(k % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs, docs.select("doc_id", "toxic"))
    assert {"дурак", "蠢货", "货们"} <= set(model["lexicon"])
    texts = ["какой дурак там", "КАКОЙ ДУРААААК", "你们蠢货们好", "река и дом", "你好世界", ""]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    said = {r["doc_id"]: r["score"] >= toxicity.THRESHOLD for r in toxicity.score(asked, model).collect()}
    assert said == {0: True, 1: True, 2: True, 3: False, 4: False, 5: False}


def test_words_are_split_by_alphabet():
    found = toxicity.foreign_words("Größe идиоооот й, hello ΑΒΓ 你好世界 हिन्दी x".encode())
    assert found == {"идиот", "и", "αβγ", "你好", "好世", "世界", "हिन्दी"}
    assert toxicity.foreign_words(b"plain") == set()
    assert toxicity.folded("Größe idi\u043et".encode()).split() == [b"grosse", b"idiot"]


def test_sample_keeps_the_natural_ratio(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TOXIC_ROWS", 200)
    docs = spark.range(20_000).selectExpr("id doc_id", "string(id) text", "int(id % 10 = 0) toxic")
    sample = toxicity._sample(docs, docs.select("doc_id", "toxic"), "doc_id", "text")
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    assert 150 < n[1] < 250 and 8 < n[0] / n[1] < 10.5
    monkeypatch.setattr(toxicity, "CLEAN_ROWS", 900)
    sample = toxicity._sample(docs, docs.select("doc_id", "toxic"), "doc_id", "text")
    assert 800 < sample.where("toxic = 0").count() < 1000


def test_words_of_few_toxic_texts_stay_in_large_tables(spark):
    rows = spark.range(12_000).selectExpr(
        "id doc_id",
        "concat(id, case when id % 6 > 0 then ' fine' when id < 18 then ' gaddok' else ' idiot' end) text",
        "int(id % 6 = 0) toxic",
    )
    model = toxicity.train(rows, rows.select("doc_id", "toxic"))
    assert set(model["lexicon"]) == {"idiot", "gaddok"}


def test_awkward_rows(awkward, no_docs, tables, model):  # noqa: F811
    _, labels = tables
    found = toxicity.score(awkward, model)
    assert found.count() == awkward.count() and found.where("score not between 0 and 1").count() == 0
    assert toxicity.score(no_docs, model).count() == 0
    kept = toxicity.drop_toxic(awkward, model)
    assert kept.schema == awkward.schema and kept.count() == awkward.count()
    untaught = toxicity.train(no_docs, labels.where("false"))
    assert toxicity.score(awkward, untaught).select("score").distinct().count() == 1
    assert toxicity.score(awkward, toxicity.train(awkward, labels.where("false"))).count() == 11


def shuffled_texts(n):
    draw = random.Random(5)
    words = [*RUDE, "the", "a", "i", "y", "well", "of", "mo", "ron", "wor", "дом", "é", "naïve", "Σ"]
    marks = [" ", " ", " ", "  ", "\t", "\n", ".", "-", "*", "/", " . ", ", ", '"', "(", "!", "***", "\u0301"]
    for _ in range(n):
        parts = []
        for _ in range(draw.randint(1, 12)):
            word = draw.choice(words)
            word = draw.choice([word, word, word.translate(LEET), draw.choice(marks).join(word), word[0]])
            parts += [word.upper() if draw.random() < 0.1 else word, draw.choice(marks)]
        yield "".join(parts)


def test_scoring_reads_only_what_may_be_a_target(model, monkeypatch):
    letters, targets = toxicity.LetterModel(model["counts"]), tuple(model["lexicon"])
    every = toxicity.Restorer(letters, targets)
    some = toxicity.Restorer(letters, targets, only_targets=True)
    found = 0
    for text in shuffled_texts(2_000):
        words = some.words(text.encode())
        assert words == every.words(text.encode()) & set(targets)
        found += bool(words)
    assert found > 500
    some = toxicity.Restorer(letters, targets, only_targets=True)
    monkeypatch.setattr(toxicity, "_SPACED", None)  # not run over texts without lone symbols
    assert some.words(b"These are well-known, plain words; (more) of 1999...") == set()
    assert not some.told and len(some.dull) == 8


def test_spaced_words_are_found_wherever_they_stand(model):
    restorer = toxicity.Restorer(toxicity.LetterModel(model["counts"]), tuple(model["lexicon"]))
    spaced = 0
    for text in shuffled_texts(2_000):
        words = restorer.words(text.encode())
        for match in toxicity._SPACED.finditer(toxicity.folded(text.encode())):
            assert words.issuperset(restorer.spaced(match[0].decode()))
            spaced += 1
    assert spaced > 200


def test_runs_beyond_ascii_fold_as_whole_texts_do():
    odd = ["\u212a", "\u0130", "\u03a3\u03a3", "\ufb01", "\u00a0", "\u2026", "\u1ec7\u0323", "\U0001d400", "?", "\u0431\u043e"]
    texts = [a + b + c + d for a, b, c, d in itertools.product(["", "Ab"], odd, ["", "c\u0301"], odd)]
    for text in [*texts, *shuffled_texts(500)]:
        whole = toxicity._ascii(toxicity.unmarked(text.encode()))
        assert toxicity.folded(text.encode()) == (text.lower().encode() if text.isascii() else whole)


def test_empty_texts_are_learned_from(spark):
    rows = [(k, [None, "", "12 34"][k % 3] if k % 4 == 0 else f"{'idiot' if k % 7 == 0 else 'fine'} {k}", int(k % 7 == 0)) for k in range(210)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").coalesce(1)
    model = toxicity.train(docs, docs.select("doc_id", "toxic"))
    assert set(model["lexicon"]) == {"idiot"}
    assert toxicity.score(docs, model).where("score is not null").count() == 210
