import math
import random
import re

import pytest

from llm_cases import awkward, no_docs  # noqa: F401
from orderlake.llm import licenses
from orderlake.llm.common import plain_words

TEXT = dict(licenses.BASE_PHRASES)


def slow_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def slow_base(words):
    return sorted(
        (i, label)
        for label, phrase in TEXT.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    )


def slow_best(words, template):
    """The largest share of the template's words in any block."""
    wanted = slow_words(template)
    span, known = math.ceil(len(wanted) / licenses.CONTAINMENT - 1e-9), set(wanted)
    best = max((len(known & set(words[i : i + span])) for i in range(len(words))), default=0)
    return best / len(known) if best >= math.ceil(licenses.CONTAINMENT * len(known) - 1e-9) else None


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(9)
    pool = sorted({w for _, t in licenses.TEMPLATES for w in slow_words(t)}) + ["filler", "Ünter"]
    found = []
    for k in range(120):
        words = [draw.choice(pool) for _ in range(draw.randint(0, 80))]
        for _ in range(draw.randint(0, 3)):
            notice = draw.choice(licenses.TEMPLATES)[1].split()
            notice = [w for w in notice if draw.random() > 0.12]
            at = draw.randint(0, len(words))
            words[at:at] = notice
        found.append((k, draw.choice([" ", "\n", " -- "]).join(words)))
    found += [(500, "under the MIT license under the mit license"), (501, "CC BY-NC cc_by_nc")]
    return found


def test_like_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    for r in licenses.scan_licenses(docs).collect():
        words = slow_words(texts[r["doc_id"]])
        assert r["n_words"] == len(words)
        assert [(b["start"], b["label"]) for b in r["base"]] == slow_base(words)
        wanted = {}
        for label, text in licenses.TEMPLATES:
            if best := slow_best(words, text):
                wanted[label] = max(best, wanted.get(label, 0))
        found = {}
        for b in r["blocks"]:
            found[b["label"]] = max(b["containment"], found.get(b["label"], 0))
        assert found == pytest.approx(wanted)


@pytest.mark.parametrize("seed", range(12))
def test_every_adjacent_notice_is_a_block(seed):
    """Against brute force: the fullest window is there, blocks match and none is left between."""
    draw = random.Random(seed)
    for label, text in licenses.TEMPLATES:
        words = []
        for _ in range(8):
            words += [w for w in slow_words(text) if draw.random() > 0.06 * (seed % 3)]
            words += ["filler"] * draw.choice([0, 0, 1, 40])
        ready = licenses.Template(label, text, {}, licenses.CONTAINMENT)
        line = [w.encode() for w in words]
        at = [i for i, w in enumerate(line) if w in ready.prefix]
        blocks = ready.blocks(line, at)
        if not seed % 3:
            assert len(blocks) == 8 and all(share == 1 for *_, share in blocks)
        if best := slow_best(words, text):
            assert max(share for *_, share in blocks) == pytest.approx(best)
        free = 0
        for start, end, share in [*blocks, (len(words), len(words), 0)]:
            assert free <= start and slow_best(words[free:start], text) is None
            assert not end - start or end - start <= ready.span
            held = ready.known & set(line[start:end])
            assert share == pytest.approx(len(held) / len(ready.known))
            free = end


def test_ten_thousand_notices_in_a_row():
    label, text = licenses.TEMPLATES[0]
    line = [w.encode() for w in slow_words(text)] * 10_000
    ready = licenses.Template(label, text, {}, licenses.CONTAINMENT)
    blocks = ready.blocks(line, [i for i, w in enumerate(line) if w in ready.prefix])
    assert [b[:2] for b in blocks] == [(5 * k, 5 * k + 5) for k in range(10_000)]


def test_words_like_the_pattern(rows):
    for _, text in rows:
        assert [w.decode() for w in plain_words(text.encode())] == slow_words(text)


def test_awkward_rows(awkward, no_docs):  # noqa: F811
    found = licenses.scan_licenses(awkward)
    assert found.count() == awkward.count() and found.where("size(base) + size(blocks) > 0").count() == 0
    assert licenses.scan_licenses(no_docs).count() == 0
