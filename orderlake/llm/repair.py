"""Repair of conversation structure: cheapest edits by an auction on the lattice of rows and roles.

A conversation should read (system)? (user assistant)+ or be empty. Rows are kept, given another
role or deleted, and empty user or assistant rows are inserted. A node of the lattice is a place
between two rows and what the repaired roles before it look like; arcs are edits with whole
costs, one per letter. Bertsekas' auction for shortest paths (1991) finds the cheapest way: nodes
have prices, no price exceeds an arc's cost plus the price at its end, and a path from the origin
grows along an arc that reaches equality (a tight one) or, where there is none, raises the price
of its last node to the least such sum and draws back. A price that the path ends with is the
exact distance to the destination. Origins are taken from the last rows to the first, a few rows
apart, so that each auction runs between two such places. Then every shortest path consists of
tight arcs, and the first in ASCII order is read off by the least tight letter at each node.

Rows that must go (blank ones, repeated ones) are no part of the lattice: their D stands before
any insertion at the same place, which is where the first path in ASCII order has it.

A conversation of any length is spread over tasks: rows are range-sorted into pieces, runs of up
to CHUNK_ROWS rows of a piece become chunks of a byte per row, a chunk's auctions from each role
state to each other give a table of sixteen costs, the tables of a conversation are summed from
its end, and the chunks are traced from all four states, of which the real one is picked last.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import stored

CHUNK_ROWS = 1 << 16
STAGE_ROWS = 8  # rows between two places whose prices are settled
PREFIX_CHARS = 64  # of a text, for cutting the range of one turn's rows
KNOWN_CONVERSATIONS = 50_000  # row patterns a task remembers the edits of
RESTORED = {"i": 2, "r": 2, "d": 3, "t": 1}  # insert, other role, delete, truncated row that stays
_BLANKS = " \t\n\x0b\x0c\r"
_NEVER = float("inf")

# What the repaired roles so far look like: nothing, a system row, up to a user row, up to an
# assistant row. The state after another user or assistant row, and after a kept row by initial.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_KEPT = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
_AT_END = [0, 2 * RESTORED["i"], RESTORED["i"], 0]  # what completes a conversation behind its last row
_TAIL = ("", "II", "I", "")
# States from which an auction may set out for an end state, and pass on its way.
_TOWARDS = ((0,), (0, 1), (0, 1, 2, 3), (0, 1, 2, 3))
_INITIALS = "sua"


def row_code(initial: str | None, truncated: bool) -> int:
    """A row that may stay as a byte; 0 is a row that must go."""
    kind = _INITIALS.find(initial) if initial else -1
    return 1 + 2 * (kind if kind >= 0 else len(_INITIALS)) + bool(truncated)


class Lattice:
    """The rows of a chunk that may stay, and the prices of its nodes."""

    def __init__(self, codes: bytes):
        self.codes = [c - 1 for c in codes if c]
        self.forced = len(codes) - len(self.codes)
        self.price: list[float] = []

    def arcs(self, node: int, states=(0, 1, 2, 3)) -> list[tuple[str, float, int]]:
        """(letter, cost, end) of the arcs of a node, in ASCII order."""
        row, state = divmod(node, 4)
        kind, truncated = divmod(self.codes[row], 2)
        extra = RESTORED["t"] * truncated
        after = _NEXT[state]
        found = [("D", RESTORED["d"], node + 4)]
        if after in states:
            found.append(("I", RESTORED["i"], 4 * row + after))
        kept = _KEPT[_INITIALS[kind]][state] if kind < len(_INITIALS) else None
        if kept is not None and kept in states:
            found.append(("K", extra, 4 * row + 4 + kept))
        if after in states:
            found.append(("R", RESTORED["r"] + extra, 4 * row + 4 + after))
        return found

    def _auction(self, origin: int, end: int, states, known: dict) -> None:
        """Raise prices until the path from ``origin`` arrives at node ``end`` or behind it."""
        price, path = self.price, [origin]
        while path:
            node = path[-1]
            if node >= end:
                return
            arcs = known.get(node)
            if arcs is None:
                arcs = known[node] = self.arcs(node, states)
            least, nearest = _NEVER, None
            for _, cost, to in arcs:
                if cost + price[to] < least:
                    least, nearest = cost + price[to], to
            if price[node] < least:
                price[node] = least
                if node == origin:
                    if least == _NEVER:
                        return
                else:
                    path.pop()
            elif least == _NEVER:
                path.pop()
            else:
                path.append(nearest)

    def settle(self, exits: list[float], states=(0, 1, 2, 3)) -> list[float]:
        """Prices of the four states at the first row, given those behind the last."""
        rows = len(self.codes)
        self.price = [_NEVER] * (4 * rows) + list(exits)
        end = rows
        while end > 0:
            first = max(0, end - STAGE_ROWS)
            floor = min(self.price[4 * end : 4 * end + 4])
            for state in states:
                self.price[4 * first + state : 4 * end : 4] = [floor] * (end - first)
            known: dict = {}
            for state in states:
                self._auction(4 * first + state, 4 * end, states, known)
            end = first
        return self.price[:4]

    def trace(self, state: int) -> tuple[str, int]:
        """The first cheapest path in ASCII order from a state at the first row: (letters of the
        rows that may stay, state behind the last)."""
        letters, node = [], state
        while node < 4 * len(self.codes):
            for letter, cost, to in self.arcs(node):
                if cost + self.price[to] == self.price[node]:
                    letters.append(letter)
                    node = to
                    break
            else:
                raise AssertionError("a settled price has a tight arc")
        return "".join(letters), node % 4


_STEP = re.compile("I*[DKR]")


def woven(codes: bytes, letters: str) -> str:
    """The letters of all rows: those that must go have their D before insertions."""
    steps = iter(_STEP.findall(letters))
    return "".join("D" if not c else next(steps) for c in codes)


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """(cost, letters) of a whole conversation."""
    lattice = Lattice(codes)
    cost = lattice.settle(_AT_END)[START]
    letters, end = lattice.trace(START)
    return int(cost) + RESTORED["d"] * lattice.forced, woven(codes, letters) + _TAIL[end]


def passage_costs(codes: bytes) -> list[float]:
    """Sixteen costs, from each state before a chunk to each behind it; infinite if there is no way."""
    lattice, found = Lattice(codes), [_NEVER] * 16
    for end in range(4):
        exits = [_NEVER] * 4
        exits[end] = 0
        prices = lattice.settle(exits, _TOWARDS[end])
        for state in _TOWARDS[end]:
            found[4 * state + end] = prices[state]
    return found


# ---------------------------------------------------------------- rows, pieces, chunks


def damaged(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The rows with planted faults, each drawn from crc32 of ``conversation:turn`` modulo 20: 0
    drops the row, 1 empties its text, 2 takes its sentence marks, 3 repeats it, 4 makes it a
    user's. A null role or text, and a null in the drawn key, counts as one space."""
    one = F.lit(" ")
    named = [F.coalesce(F.col(c).cast("string"), one) for c in (conv_col, turn_col)]
    draw = F.crc32(F.concat(named[0], F.lit(":"), named[1]).cast("binary")) % 20
    text = F.coalesce(F.col(text_col), one)
    rows = conversations.select(
        F.col(conv_col),
        F.col(turn_col),
        F.when(draw == 4, "user").otherwise(F.coalesce(F.col(role_col), one)).alias(role_col),
        F.when(draw == 1, "")
        .when(draw == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias(text_col),
        F.when(draw == 0, 0).when(draw == 3, 2).otherwise(1).alias("__copies"),
    ).where("__copies > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__copy")
    return rows.withColumn("__copies", copies).drop("__copies")


def _mapped(frame: DataFrame, schema: str, run: Callable) -> DataFrame:
    """mapInArrow for a function that yields lists of row tuples."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(frame.sparkSession.createDataFrame([], schema).schema)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in run(found):
            if rows:
                arrays = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(target)]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return frame.mapInArrow(batches, schema)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns], strict=True)


def _together(rows: Iterator, weight: Callable, most: int) -> Iterator[list]:
    """Rows in lists of bounded weight."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= most:
            yield held
            held, size = [], 0
    yield held


def arranged(rows: DataFrame, conv: Column, turn: Column, role: Column, text: Column) -> DataFrame:
    """The rows in order, stored: (conv, turn, role, text, blank, truncated, at); ``at`` ascends with
    conversation, turn (nulls first), role and text, without gaps inside a piece."""
    last = F.right(F.rtrim(F.col("text"), F.lit(_BLANKS)), F.lit(1))
    named = rows.select(
        conv.alias("conv"),
        turn.cast("long").alias("turn"),
        F.coalesce(role, F.lit(" ")).alias("role"),
        F.coalesce(text, F.lit(" ")).alias("text"),
    )
    # rows that agree in all of this lie in one piece
    place = ["conv", "turn", "role"]
    cut = F.substring("text", 1, PREFIX_CHARS)
    ordered = named.repartitionByRange(*place, cut).sortWithinPartitions(*place, "text")
    return stored(
        ordered.select(
            "*",
            (last == "").alias("blank"),
            (~last.isin(".", "!", "?")).alias("truncated"),
            F.monotonically_increasing_id().alias("at"),
        ),
        "repair-rows",
    )


def _piece(at: str = "at") -> Column:
    return F.shiftright(at, 33)


def _chunked(chunk_rows: int):
    def finished(held) -> tuple:
        conv, at, rows = held
        codes, faults, illegal, turns = bytearray(), [0, 0, 0], 0, []
        before = None
        for turn, initial, blank, truncated, first in rows:
            if turn is not None and (not turns or turns[-1] != turn):
                turns.append(turn)
            if before is not None and before + initial not in ("su", "ua", "au"):
                illegal += 1
            before = initial
            fault = 0 if blank else 1 if not first else 2 if truncated else None
            if fault is not None:
                faults[fault] += 1
            codes.append(row_code(initial, truncated) if fault in (None, 2) else 0)
        low, high = (turns[0], turns[-1]) if turns else (None, None)
        return (conv, at, bytes(codes), *faults, illegal, rows[0][1], before, low, high, len(turns))

    def chunks(batches):
        held, piece_before, first_at = None, None, None
        for piece, at, mark, conv, turn, initial, blank, truncated in _listed(batches):
            if not mark:
                first_at = at
                continue
            fresh = held is None or piece != piece_before or conv != held[0]
            if fresh or len(held[2]) >= chunk_rows:
                if held:
                    yield finished(held)
                held = (conv, at, [])
            held[2].append((turn, initial, blank, truncated, at == first_at))
            piece_before = piece
        if held:
            yield finished(held)

    return lambda batches: _together(chunks(batches), lambda c: len(c[2]) + 100, 1 << 22)


def _chunks(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """Runs of rows of one conversation and piece, a byte per row, with what is counted on them."""
    kind = rows.schema["conv"].dataType.simpleString()
    # of all rows with one role and text, the first is no repetition
    first = (
        rows.where("not blank")
        .groupBy("conv", "role", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("text"))
        .agg(F.min("at").alias("at"))
    )
    slim = rows.select(
        _piece().alias("piece"), "at", F.lit(1).alias("mark"), "conv", "turn",
        F.substring("role", 1, 1).alias("initial"), "blank", "truncated",
    )
    marks = first.select(_piece().alias("piece"), "at", F.lit(0).alias("mark"))
    flow = (
        slim.unionByName(marks, allowMissingColumns=True)
        .repartition("piece")
        .sortWithinPartitions("piece", "at", "mark")
    )
    schema = (
        f"conv {kind}, at long, codes binary, blank long, duplicate long, truncated long,"
        " illegal long, head string, tail string, low long, high long, turns long"
    )
    return stored(_mapped(flow, schema, _chunked(chunk_rows)), "repair-chunks")


def _whole(batches):
    """Edits of conversations that are one chunk."""
    known: dict[bytes, tuple[int, str]] = {}

    def rows():
        for conv, at, codes in _listed(batches):
            found = known.get(codes)
            if found is None:
                if len(known) >= KNOWN_CONVERSATIONS:
                    known.clear()
                found = known[codes] = cheapest_edits(codes)
            yield conv, at, START, *found

    return _together(rows(), lambda r: len(r[4]) + 50, 1 << 22)


def _spread(parts: DataFrame, kind: str) -> DataFrame:
    """Edits of conversations of several chunks: (conv, at, entry, cost, letters)."""

    def costs(batches):
        rows = ((conv, at, passage_costs(codes)) for conv, at, codes in _listed(batches))
        return _together(rows, lambda _: 1, 1000)

    def summed(chunks: pd.DataFrame) -> pd.DataFrame:
        chunks = chunks.sort_values("at", ascending=False)
        exits, found = [float(c) for c in _AT_END], []
        for passage in chunks["passage"]:
            found.append(exits)
            exits = [min(passage[4 * s + e] + exits[e] for e in range(4)) for s in range(4)]
        return pd.DataFrame({"at": chunks["at"], "exits": found, "last": [k == 0 for k in range(len(found))]})

    def traced(batches):
        def rows():
            for conv, at, codes, exits, last in _listed(batches):
                lattice = Lattice(codes)
                prices = lattice.settle(exits)
                letters, ends = [], []
                for state in range(4):
                    found, end = lattice.trace(state)
                    letters.append(woven(codes, found) + (_TAIL[end] if last else ""))
                    ends.append(end)
                yield conv, at, lattice.forced, prices, ends, letters

        return _together(rows(), lambda r: 4 * len(r[5][0]) + 50, 1 << 22)

    def followed(chunks: pd.DataFrame) -> pd.DataFrame:
        chunks = chunks.sort_values("at")
        state, found = START, []
        for ends in chunks["ends"]:
            found.append(state)
            state = ends[state]
        return pd.DataFrame({"at": chunks["at"], "entry": found, "opens": [k == 0 for k in range(len(found))]})

    passages = _mapped(parts, f"conv {kind}, at long, passage array<double>", costs)
    exits = passages.groupBy("conv").applyInPandas(summed, "at long, exits array<double>, last boolean")
    paths = stored(
        _mapped(
            parts.join(exits, "at").select("conv", "at", "codes", "exits", "last"),
            f"conv {kind}, at long, forced long, prices array<double>, ends array<int>,"
            " letters array<string>",
            traced,
        ),
        "repair-paths",
    )
    entries = (
        paths.select("conv", "at", "ends")
        .groupBy("conv")
        .applyInPandas(followed, "at long, entry int, opens boolean")
    )
    cost = F.when(F.col("opens"), F.get("prices", "entry")).otherwise(0.0).cast("long")
    return paths.join(entries, "at").select(
        "conv",
        "at",
        "entry",
        (cost + RESTORED["d"] * F.col("forced")).alias("cost"),
        F.get("letters", "entry").alias("letters"),
    )


@dataclass
class Repair:
    """``rows``: the conversations in order; ``edits``: letters and entry state of their chunks;
    ``summary``: a row per conversation with what was found and the cost of its edits."""

    rows: DataFrame
    edits: DataFrame
    summary: DataFrame


def repair(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    chunk_rows: int = CHUNK_ROWS,
) -> Repair:
    """The cheapest edits that give every conversation roles whose initials read (s?(ua)+)?.

    Rows of a conversation stand by turn (nulls first), then role and text, so that ties have one
    order; null roles and texts count as one space. A row is blank (no character but the six ASCII
    blanks), else duplicate (role and text of an earlier row), else truncated (last such character
    none of .!?). Keeping costs 0, another role 2, deleting 3 (blank and duplicate rows must go),
    inserting an empty user or assistant row 2, a truncated row that stays 1 more. Of the cheapest
    edits the one whose letters (K, R, D, I) come first in ASCII order is taken.

    ``summary``: (conv, gaps, blank, duplicate, truncated, illegal, cost: long). gaps is the last
    turn minus the first plus one minus the distinct turns, nulls aside (no turn: 0; null beyond 64
    bits); illegal counts neighbours whose initials are none of su, ua, au. A null conversation id
    is one conversation; conversations without rows are not known here; an empty table gives no
    rows; only the four named columns are read. Turns must be whole numbers.
    """
    rows = arranged(
        conversations, F.col(conv_col), F.col(turn_col), F.col(role_col), F.col(text_col)
    )
    kind = rows.schema["conv"].dataType.simpleString()
    chunks = _chunks(rows, chunk_rows)
    order = Window.partitionBy("conv").orderBy("at")
    met = chunks.drop("codes").select(
        "*",
        F.count("*").over(Window.partitionBy("conv")).alias("parts"),
        F.lag("tail").over(order).alias("before"),
        F.lag("at").over(order).isNotNull().alias("follows"),
        F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("reached"),
    )
    met = stored(met, "repair-met")
    split = met.where("parts > 1").select("at")

    def coded(which: str) -> DataFrame:
        return chunks.join(split, "at", which).select("conv", "at", "codes")

    edit_schema = f"conv {kind}, at long, entry int, cost long, letters string"
    edits = _mapped(coded("left_anti"), edit_schema, _whole)
    if split.head(1):
        edits = edits.unionByName(_spread(coded("left_semi"), kind))
    edits = stored(edits, "repair-edits")

    seam = F.col("follows") & ~F.concat("before", "head").isin("su", "ua", "au")
    again = F.col("low").eqNullSafe(F.col("reached")) & F.col("low").isNotNull()
    wide = "decimal(38,0)"
    span = F.max("high").cast(wide) - F.min("low").cast(wide) + 1
    turns = F.sum("turns") - F.count_if(again)
    found = met.groupBy("conv").agg(
        F.when(F.max("high").isNull(), F.lit(0).cast("long"))
        .otherwise((span - turns.cast(wide)).try_cast("long"))
        .alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        (F.sum("illegal") + F.count_if(seam)).alias("illegal"),
    )
    cost = edits.groupBy("conv").agg(F.sum("cost").alias("cost"))
    summary = found.alias("f").join(cost.alias("c"), F.expr("f.conv <=> c.conv")).select(
        "f.conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"
    )
    return Repair(rows, edits, summary)


# ---------------------------------------------------------------- what the edits make


def _edited(flow: Iterator[tuple]) -> Iterator[tuple]:
    """(conv, at, place, edit, role, text) from chunks' letters followed by their rows; the rows
    inserted behind a conversation's last come with its ``at``. Deleted rows have no role."""
    steps, state, rest = iter(()), START, None

    def inserted(conv, at, places, count):
        nonlocal state
        for place in places[:count]:
            state = _NEXT[state]
            yield conv, at, place, "I", _ROLE[state], ""

    for conv, at, kind, role, text, letters, entry in flow:
        if kind == 0:
            found = _STEP.findall(letters)
            trailing = len(letters) - sum(map(len, found))
            steps, state, rest = iter(found), entry, [len(found), trailing]
            continue
        step = next(steps)
        yield from inserted(conv, at, range(len(step)), len(step) - 1)
        edit, place = step[-1], len(step) - 1
        if edit == "D":
            yield conv, at, place, "D", None, text
        elif edit == "R":
            state = _NEXT[state]
            yield conv, at, place, "R", _ROLE[state], text
        else:
            state = _KEPT[role[0]][state]
            yield conv, at, place, "K", role, text
        rest[0] -= 1
        if not rest[0] and rest[1]:
            yield from inserted(conv, at, range(place + 1, place + 3), rest[1])


def _flow(found: Repair) -> DataFrame:
    kept = ["conv", "at", "kind", "role", "text", "letters", "entry"]
    rows = found.rows.select("conv", "at", F.lit(1).alias("kind"), "role", "text")
    edits = found.edits.select("conv", "at", F.lit(0).alias("kind"), "letters", "entry")
    return rows.unionByName(edits, allowMissingColumns=True).select(*kept)


def repaired_rows(found: Repair) -> DataFrame:
    """(conv, at, place, edit, role, text): every edit in the order of (at, place); the repaired
    conversation is the rows whose edit is not D. Pieces stay together, whatever their conversations."""

    def run(batches):
        return _together(_edited(_listed(batches)), lambda r: len(r[5]) + 50, 1 << 22)

    kind = found.rows.schema["conv"].dataType.simpleString()
    flow = _flow(found).repartition(_piece()).sortWithinPartitions("at", "kind")
    schema = f"conv {kind}, at long, place int, edit string, role string, text string"
    return _mapped(flow, schema, run)


def digests(found: Repair) -> DataFrame:
    """(conv, audit, repaired_sha256): all letters, and the hash of the repaired ``role:text`` rows
    joined by newlines. A hash is made in order, so the rows of a conversation pass one task, as a
    sorted stream of which it holds a batch and the letters."""

    def run(batches):
        def rows():
            now, letters, sha, some = None, [], None, False
            for conv, _, _, edit, role, text in _edited(_listed(batches)):
                if sha is None or conv != now:
                    if sha is not None:
                        yield now, "".join(letters), sha.hexdigest()
                    now, letters, sha, some = conv, [], hashlib.sha256(), False
                letters.append(edit)
                if edit != "D":
                    sha.update(f"{chr(10) if some else ''}{role}:{text}".encode())
                    some = True
            if sha is not None:
                yield now, "".join(letters), sha.hexdigest()

        return _together(rows(), lambda r: len(r[1]) + 100, 1 << 22)

    kind = found.rows.schema["conv"].dataType.simpleString()
    flow = _flow(found).repartition("conv").sortWithinPartitions("conv", "at", "kind")
    return _mapped(flow, f"conv {kind}, audit string, repaired_sha256 string", run)
