import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import awkward, no_docs  # noqa: F401
from orderlake.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits[::-1])) % 10 == 0


def brute(text):
    spans = [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    spans += [
        (m.start(), m.end(), "ip")
        for m in IP.finditer(text)
        if all(int(p) <= 255 for p in m[0].split("."))
    ]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c in "0123456789"]
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), m.end(), "card"))
    for m in PHONE.finditer(text):
        if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            spans.append((m.start(), m.end(), "phone"))
    return sorted(spans, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab.@-+%_ 0123459()\nü", max_size=60))
def test_fixed_shapes_like_their_patterns(text):
    assert pii.fixed_spans(text) == brute(text)


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c@d.e x@y, 256.1.1.1 0255.1.1.001 1.2.3.4.5.6.7.8",
        "4111 1111-1111 1111 and 4111111111111112 and +1 (425) 555-9684.",
        "9" * 3000 + ".1.2.3 " + "a" * 5000 + "@" + "b" * 5000,
        "é" * 7 + " jo.81@mail7.example.com",
    ],
)
def test_fixed_shapes_of_hard_texts(text):
    assert pii.fixed_spans(text) == brute(text)


def test_documents_like_their_patterns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in pii.find_pii(docs).collect():
        assert [(s["start"], s["end"], s["kind"]) for s in r["fixed"]] == brute(texts[r["doc_id"]] or "")


@pytest.fixture(scope="module")
def letters(spark):
    """Members introduced by one phrase: most by a known shape, some by an unknown one."""
    draw = random.Random(4)
    words = [f"{a}{b}" for a in "abcdefghij" for b in ("lo", "ta", "ri", "su")]
    make = lambda n: " ".join(draw.choice(words) for _ in range(n))
    rows = []
    for k in range(60):
        who = f"m{k}.{draw.randint(10, 99)}@mail.example.org" if k < 50 else f"member-{k}88712"
        rows.append((k, f"{make(30)} reach me under {who} any time {make(20)}"))
    rows += [(100 + k, f"{make(20)} version {draw.randint(1000, 9999)} of {make(9)}") for k in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


def test_contexts_discover_unseen_identifiers(letters):
    docs, rows = letters
    patterns = {r["pattern"]: r["kind"] for r in pii.learn_patterns(docs).collect()}
    assert patterns["me under _"] == "email" and patterns["_ any time"] == "email"
    assert not any("version" in p for p in patterns)
    texts = dict(rows)
    for r in pii.find_pii(docs).collect():
        added = [texts[r["doc_id"]][s["start"] : s["end"]] for s in r["added"]]
        assert added == ([f"member-{r['doc_id']}88712"] if 50 <= r["doc_id"] < 60 else [])


def test_masking_keeps_columns_and_rows(letters, awkward):  # noqa: F811
    docs, _ = letters
    masked = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert "under <EMAIL> any time" in masked[3] and "under <EMAIL> any time" in masked[55]
    assert "@" not in "".join(masked.values())
    kept = pii.redact(awkward)
    assert kept.schema == awkward.schema and kept.count() == awkward.count()
    assert pii.masked("a@b.cc 1.2.3.4@x.yy", {}) == "<EMAIL> <EMAIL>"


def test_rare_contexts_discover_in_a_large_corpus(spark):
    """A context of 12 places among 120,000 others keeps its patterns."""
    rows = [(k, f"x{k} write to desk jo{k}@mail.example.org before noon y{k}") for k in range(11)]
    rows.append((11, "x11 write to desk member-5088712 before noon y11"))
    other = " ".join(f"item{k % 7} 20{k % 90 + 10} of{k % 5}" for k in range(1000))
    rows += [(100 + k, other) for k in range(120)]
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    added = {r["doc_id"]: r["added"] for r in found.collect()}
    assert [rows[11][1][s["start"] : s["end"]] for s in added[11]] == ["member-5088712"]


def test_joined_patterns_do_the_same(letters, awkward, monkeypatch):  # noqa: F811
    docs, _ = letters
    collected = lambda frame: sorted(map(str, frame.collect()))
    sent = collected(pii.find_pii(docs)), collected(pii.redact(docs))
    monkeypatch.setattr(pii, "SENT_PATTERNS", 0)
    assert (collected(pii.find_pii(docs)), collected(pii.redact(docs))) == sent
    kept = pii.redact(awkward)
    assert kept.schema == awkward.schema and kept.count() == awkward.count()


def found_in(text):
    return [text[p[0] : p[1]] for p in pii.places(text, pii.fixed_spans(text)) if not p[4]]


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("call (020) 7946 0958 now", ["(020) 7946 0958"]),
        ("card 4111 1111 1111 1112, thanks", ["4111 1111 1111 1112"]),
        ("one 4111-1111.1111 (11) 12.", ["4111-1111.1111 (11) 12"]),
        ("in 2019. 2020 was", ["2019", "2020"]),
        ("ab-1234 cd 12 34 member-5088712", ["ab-1234", "12 34", "member-5088712"]),
        ("3 1980s cars and 7 x", ["1980s"]),
        ("jo@mail.example.org 020 7946 0958 or 1.2.3.4", ["020 7946 0958"]),
    ],
)
def test_groups_of_digits_are_one_place(text, wanted):
    assert found_in(text) == wanted


def test_long_runs_are_linear():
    assert found_in("1 " * 100_000) == ["1 " * 99_999 + "1"]
    assert found_in("1" * 200_000 + "x") == ["1" * 200_000 + "x"]


def test_grouped_numbers_are_found_whole():
    patterns = {"call me _": ("phone", 0.9), "my card _": ("card", 0.9)}
    assert pii.masked("call me (020) 7946 0958 today", patterns) == "call me <PHONE> today"
    assert pii.masked("my card 4111 1111 1111 1112 is", patterns) == "my card <CARD> is"


def test_awkward_rows(awkward, no_docs):  # noqa: F811
    assert all(not r["fixed"] and not r["added"] for r in pii.find_pii(awkward).collect())
    assert pii.find_pii(awkward).count() == awkward.count()
    assert pii.find_pii(no_docs).count() == 0
