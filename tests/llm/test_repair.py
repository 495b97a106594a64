import functools
import hashlib
import random
import re
import zlib

import pytest
from orderlake.llm import queries, repair
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
WANTED = re.compile("(s?(ua)+)?")
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """(cost, audit, roles) over all edits of (initial, must go, truncated) rows, by recursion over
    the places of the full lattice; ties by the audit."""

    @functools.cache
    def best(i, state, inserts):
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []

        def take(cost, letter, after, i, inserts, made):
            rest = best(i, after, inserts)
            if rest:
                found.append((cost + rest[0], letter + rest[1], (made, *rest[2]) if made else rest[2]))

        for role in "ua":
            if inserts < 3 and (state, role) in STEP:
                take(2, "I", role, i, inserts + 1, ("I", role, None))
        if i < len(rows):
            initial, must_go, truncated = rows[i]
            take(3, "D", state, i + 1, 0, None)
            if not must_go:
                if (state, initial) in STEP:
                    take(truncated, "K", initial, i + 1, 0, ("K", None, i))
                for role in "ua":
                    if (state, role) in STEP:
                        take(2 + truncated, "R", role, i + 1, 0, ("R", role, i))
        return min(found, default=None)

    for i in range(len(rows), -1, -1):  # from the end, so that recursion stays shallow
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    return best(0, "", 0)


def drawn_rows(draw, n):
    return [
        (draw.choice(draw.choice(["sua", "ua", "suatx", "u"])), draw.random() < 0.15, draw.random() < 0.25)
        for _ in range(n)
    ]


def codes_of(rows):
    return bytes(0 if gone else repair.row_code(initial, cut) for initial, gone, cut in rows)


def test_edits_like_brute_force():
    draw = random.Random(11)
    for _ in range(4000):
        rows = drawn_rows(draw, draw.randint(0, 12))
        cost, audit, made = cheapest(tuple(rows))
        assert repair.cheapest_edits(codes_of(rows)) == (cost, audit), rows
        assert WANTED.fullmatch("".join(role or rows[i][0] for _, role, i in made))


def test_edits_of_long_conversations_like_brute_force():
    draw = random.Random(12)
    for _ in range(30):
        rows = drawn_rows(draw, draw.randint(60, 150))
        assert repair.cheapest_edits(codes_of(rows)) == cheapest(tuple(rows))[:2]


def test_passages_add_up():
    draw = random.Random(13)
    for _ in range(300):
        rows = drawn_rows(draw, draw.randint(0, 30))
        cut = draw.randint(0, len(rows))
        one, other = map(repair.passage_costs, (codes_of(rows[:cut]), codes_of(rows[cut:])))
        way = min(one[k] + other[4 * k + e] + repair._AT_END[e] for k in range(4) for e in range(4))
        gone = sum(r[1] for r in rows)
        assert way + 3 * gone == repair.cheapest_edits(codes_of(rows))[0]


def slow(rows):
    """The query's rows from (conv_id, turn, role, text)."""
    groups = {}
    for conv, turn, role, text in rows:
        held = groups.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        held += [(turn, "user" if draw == 4 else role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    found = []
    for conv, held in groups.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen, plan = [0, 0, 0], set(), []
        for _, role, text in held:
            stripped = text.strip(" \t\n\x0b\x0c\r")
            fault = 0 if not stripped else 1 if (role, text) in seen else 2 if stripped[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                faults[fault] += 1
            plan.append((role[:1], fault < 2, fault == 2))
        turns = [r[0] for r in held if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:], strict=False))
        cost, audit, made = cheapest(tuple(plan))
        names = {"u": "user", "a": "assistant"}
        text = "\n".join(
            f"{names.get(role) or held[i][1]}:{'' if i is None else held[i][2]}" for _, role, i in made
        )
        found.append((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(found, key=str)


def result(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_query_like_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert result(queries.op11_conversation_repair(spark, SF_DIR)) == slow(map(tuple, rows.collect()))


def awkward_rows():
    draw = random.Random(3)
    texts = ["Yes.", "No!", "and then", "", " \n", None, "Really?", "x" * 200_000 + ".", "ünï 😀 …", "Ja. \t"]
    roles = ["user", "assistant", "system", None, "", "tool", "umpire", "Assistant"]
    rows = [
        (draw.choice([None, *range(40)]), draw.choice([None, *range(9)]), draw.choice(roles), draw.choice(texts))
        for _ in range(400)
    ]
    rows += rows[:60]  # repeated rows
    rows += [(100, None, draw.choice(roles), f"line {k % 50}.") for k in range(300)]  # no turns
    rows += [(101, k, "user", "same.") for k in range(200)]
    rows += [(102, -(2**62), "user", "far."), (102, 2**62, "assistant", "off.")]
    return rows


def frame_of(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("conv", "at", "kind", "blank", "codes", "cost", "letters"):
        frame = frame.withColumn(name, F.lit("clash"))
    return frame


@pytest.mark.parametrize("chunk_rows,partitions", [(1 << 16, "8"), (7, "8"), (1, "3")])
def test_awkward_rows_in_chunks_of_any_size(spark, conf, monkeypatch, tmp_path, chunk_rows, partitions):
    conf(spark__sql__shuffle__partitions=partitions, spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = awkward_rows()
    frame_of(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    monkeypatch.setattr(queries.repair, "repair", functools.partial(repair.repair, chunk_rows=chunk_rows))
    assert result(queries.op11_conversation_repair(spark, str(tmp_path))) == slow(rows)


def test_repaired_rows(spark):
    rows = awkward_rows()
    found = repair.repair(repair.damaged(frame_of(spark, rows)), chunk_rows=5)
    made = sorted(map(tuple, repair.repaired_rows(found).collect()), key=lambda r: r[1:3])
    want = {row[0]: row[7:] for row in slow(rows)}
    for conv in {r[0] for r in made}:
        mine = [r for r in made if r[0] == conv]
        text = "\n".join(f"{role}:{text}" for *_, edit, role, text in mine if edit != "D")
        assert ("".join(r[3] for r in mine), hashlib.sha256(text.encode()).hexdigest()) == want[conv]


def test_no_rows(spark, tmp_path):
    frame_of(spark, awkward_rows()).where("false").write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op11_conversation_repair(spark, str(tmp_path)).count() == 0
