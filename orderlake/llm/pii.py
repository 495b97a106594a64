"""Personal data: fixed shapes, and identifiers found by bootstrapped contexts.

The fixed shapes (e-mail, IP address, payment card, phone number) are the seeds. Around each seed
stand lexical patterns: two words before, one word on either side, two words behind. Spark counts
the graph of patterns and the instances seen in them and scores it in turns: a pattern is as good
as the instances it holds, an instance as good as its patterns make it. Good patterns then mark
identifier-like tokens that no fixed shape covers.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import map_rows, stored, texts_of

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
CONFIDENCE = 0.8  # least score of a pattern that may discover
MIN_INSTANCES = 5  # distinct instances a pattern must hold
SENT_PATTERNS = 40_000  # a pattern table up to this size goes to every task; a larger one is joined
_SALTS = 16  # tasks that share the places of one pattern in that join

# The shapes. A digit before an address can only belong to a number that failed
# already, so the look-behind changes no match and keeps long digit runs linear.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARACTERS = frozenset(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
)
_DIGITS = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
# Groups of digits joined by a space, a dot, hyphens or brackets; no group touches a letter.
_RUN = re.compile(
    r"(?<![\w@])\+?(?:[(\[](?=[0-9]++[)\]]))?[0-9]++(?![^\W0-9]|@)"
    r"(?:(?:[\x20.]|(?:\x20?[-()\[\]]){1,2}\x20?)[0-9]++(?![^\W0-9]|@))*+"
)
_EDGES = "\"'()[]{}<>,;:.!?*#&%$"

Span = tuple[int, int, str]
_SPANS = "array<struct<start:int,end:int,kind:string>>"
_NODE, _ADDED = "__orderlake_text_hash", "__orderlake_added"


def _luhn(digits: list[int]) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        doubled = digit * 2 if place % 2 else digit
        total += doubled - 9 if doubled > 9 else doubled
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from each @ to both sides: linear also in long runs of letters."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARACTERS:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            free = match.end()
            yield start, free, "email"
        at = text.find("@", max(at + 1, free))


def fixed_spans(text: str) -> list[Span]:
    """Spans of the fixed shapes by (start, kind as listed); code points, end exclusive."""
    spans = list(_emails(text))
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
                spans.append((m.start(), m.end(), "ip"))
        for m in _CARD.finditer(text):
            digits = [int(c) for c in m[0] if c not in " -"]
            if 12 <= len(digits) <= 19 and _luhn(digits):
                spans.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    spans.append((m.start(), m.end(), "phone"))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def _looks_like(token: str) -> bool:
    """Identifier-like: four digits or more, or an @ inside."""
    return "@" in token.strip("@") or len(_DIGITS.findall(token)) >= 4


def _candidates(text: str, tokens: list[tuple[int, int]], taken: list[Span]) -> list[tuple[int, int]]:
    """Identifier-like tokens and runs of digit groups outside the seeds; what overlaps is one."""
    seed_from = [s[0] for s in taken]
    found = []
    for start, end in tokens:
        raw = text[start:end]
        if not _looks_like(raw):
            continue
        k = bisect_left(seed_from, end)
        if k and taken[k - 1][1] > start:
            continue
        body = raw.strip(_EDGES)
        if body and _looks_like(body):
            begin = start + len(raw) - len(raw.lstrip(_EDGES))
            found.append((begin, begin + len(body)))
    low = 0
    for start, end in [*[s[:2] for s in taken], (len(text), len(text))]:
        for m in _RUN.finditer(text, low, max(low, start)):
            if len(_DIGITS.findall(m[0])) >= 4:
                found.append(m.span())
        low = max(low, end)
    merged: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if merged and start < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def places(text: str, fixed: list[Span]) -> list[tuple[int, int, str, list[str], bool]]:
    """(start, end, kind, patterns, seed) of every seed and every other identifier-like token or
    run of digit groups.

    Overlapping seeds count as one place of the first one's kind. The kind of the others is
    empty. Patterns name the words around, lower-cased and without punctuation at their ends.
    """
    if not fixed and not _DIGITS.search(text) and "@" not in text:
        return []
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    starts, ends = [t[0] for t in tokens], [t[1] for t in tokens]
    taken, last = [], -1
    for start, end, kind in fixed:
        if start >= last:
            taken.append((start, end, kind))
        last = max(last, end)
    found = [(s, e, kind, True) for s, e, kind in taken]
    found += [(s, e, "", False) for s, e in _candidates(text, tokens, taken)]

    def word(k: int) -> str:
        return text[starts[k] : ends[k]].lower().strip(_EDGES) if 0 <= k < len(tokens) else ""

    result = []
    for start, end, kind, seed in sorted(found):
        first, after = bisect_right(starts, start) - 1, bisect_left(starts, end)
        one, two = word(first - 1), word(first - 2)
        nxt, then = word(after), word(after + 1)
        patterns = []
        if one and two:
            patterns.append(f"{two} {one} _")
        if one:
            patterns.append(f"{one} _")
        if one and nxt:
            patterns.append(f"{one} _ {nxt}")
        if nxt and then:
            patterns.append(f"_ {nxt} {then}")
        result.append((start, end, kind, patterns, seed))
    return result


def _emit_edges():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in texts_of(batch, "text"):
                text = raw.decode() if raw else ""
                for start, end, kind, patterns, seed in places(text, fixed_spans(text)):
                    name = hashlib.blake2b(text[start:end].encode(), digest_size=8).digest()
                    instance = int.from_bytes(name, "little", signed=True)
                    rows += [(pattern, instance, kind if seed else None) for pattern in patterns]
            columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.string()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.string()),
                ],
                names=["pattern", "instance", "seed"],
            )

    return run


def learn_patterns(
    docs: DataFrame,
    text_col: str = "text",
    rounds: int = ROUNDS,
    confidence: float = CONFIDENCE,
    min_instances: int = MIN_INSTANCES,
) -> DataFrame:
    """(pattern, score, kind): patterns good enough to discover identifiers.

    Seeds have score 1. In each round a pattern's score is the mean score of its places times the
    share of its commonest seed kind among its seeds; an instance that is no seed takes the best
    score of its patterns. Edges are summed per (pattern, instance) first, so a frequent word or
    copied text is one row; patterns held by fewer than ``min_instances`` different instances
    cannot discover, and nothing else depends on the size of the corpus.
    """
    edges = docs.select(F.col(text_col).alias("text")).mapInArrow(
        _emit_edges(), "pattern string, instance long, seed string"
    )
    graph = stored(
        edges.groupBy("pattern", "instance", "seed").agg(F.count("*").alias("n")), "pii-graph"
    )
    held = graph.groupBy("pattern").agg(F.count("*").alias("held"))
    wide = held.where(F.col("held") >= min_instances)
    graph = stored(graph.join(wide.select("pattern"), "pattern"), "pii-graph")
    kinds = graph.where("seed is not null").groupBy("pattern", "seed").agg(F.sum("n").alias("n"))
    main = kinds.groupBy("pattern").agg(
        F.max(F.struct("n", "seed")).alias("top"), F.sum("n").alias("seeds")
    )
    main = main.select(
        "pattern", F.col("top.seed").alias("kind"), (F.col("top.n") / F.col("seeds")).alias("pure")
    )
    believed = graph.select(
        "pattern",
        "instance",
        "n",
        F.when(F.col("seed").isNotNull(), 1.0).otherwise(0.0).alias("belief"),
    )
    for turn in range(rounds):
        mean = F.sum(F.col("n") * F.col("belief")) / F.sum("n")
        scores = believed.groupBy("pattern").agg(mean.alias("mean")).join(main, "pattern")
        scores = stored(
            scores.select("pattern", "kind", (F.col("mean") * F.col("pure")).alias("score")),
            "pii-scores",
        )
        if turn + 1 < rounds:
            joined = graph.join(scores, "pattern", "left")
            best = joined.groupBy("instance").agg(F.max(F.coalesce("score", F.lit(0.0))).alias("b"))
            believed = graph.join(best, "instance").select(
                "pattern",
                "instance",
                "n",
                        F.when(F.col("seed").isNotNull(), 1.0).otherwise(F.col("b")).alias("belief"),
            )
    return scores.where(F.col("score") >= confidence).select("pattern", "kind", "score")


def discovered(
    text: str, fixed: list[Span], patterns: dict[str, tuple[str, float]]
) -> list[Span]:
    """Spans that the patterns add to the fixed ones, each of the kind of its best pattern."""
    if not patterns:
        return []
    spans = []
    for start, end, _, around, seed in places(text, fixed):
        known = [patterns[p] for p in around if p in patterns]
        if not seed and known:
            kind, _ = max(known, key=lambda k: (k[1], k[0]))
            spans.append((start, end, kind))
    return spans


def _emit_places():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            nodes = batch.column("node").to_pylist()
            for node, raw in zip(nodes, texts_of(batch, "text"), strict=True):
                text = raw.decode() if raw else ""
                for start, end, _, patterns, seed in places(text, fixed_spans(text)):
                    if not seed:
                        rows += [(node, start, end, pattern) for pattern in patterns]
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["node", "start", "end", "pattern"],
            )

    return run


def _joined_spans(docs: DataFrame, text_col: str, patterns: DataFrame) -> DataFrame:
    """(node, added) by hash of the text: what ``discovered`` finds, by a join on the pattern."""
    texts = docs.select(F.xxhash64(text_col).alias("node"), F.col(text_col).alias("text"))
    seen = texts.mapInArrow(_emit_places(), "node long, start int, end int, pattern string")
    seen = seen.withColumn("salt", F.pmod(F.xxhash64("node", "start"), F.lit(_SALTS)))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long")))
    good = patterns.withColumn("salt", salts)
    best = (
        seen.join(good, ["pattern", "salt"])
        .groupBy("node", "start", "end")
        .agg(F.max(F.struct("score", "kind")).alias("best"))
    )
    span = F.struct("start", "end", F.col("best.kind").alias("kind"))
    return best.groupBy("node").agg(F.sort_array(F.collect_list(span)).alias("added"))


def _few(patterns: DataFrame):
    """The pattern table as a broadcast mapping if it is small, else nothing."""
    if patterns.count() > SENT_PATTERNS:
        return None
    known = {row["pattern"]: (row["kind"], row["score"]) for row in patterns.collect()}
    return patterns.sparkSession.sparkContext.broadcast(known)


def _span_rows(spans: list[Span]) -> list[dict]:
    return [{"start": s, "end": e, "kind": k} for s, e, k in spans]


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **learning) -> DataFrame:
    """Per row of ``docs``: (id, fixed, added), arrays of (start int, end int, kind string).

    ``fixed`` holds the fixed shapes, ``added`` what contexts discovered; positions are code
    points, ends exclusive, both sorted by (start, kind as listed). Null and empty texts have no
    spans; repeated rows are each reported; only the named columns are read. Up to SENT_PATTERNS
    patterns go to every task; more are joined with the places, with the same result.
    """
    patterns = stored(learn_patterns(docs, text_col, **learning), "pii-patterns")
    sent = _few(patterns)

    def spans_of(known, key, node, raw):
        text = raw.decode() if raw else ""
        fixed = fixed_spans(text)
        return key, node, _span_rows(fixed), _span_rows(discovered(text, fixed, known))

    kind = docs.schema[id_col].dataType.simpleString()
    found = map_rows(
        docs.select(
            F.col(id_col).alias("id"), F.xxhash64(text_col).alias("node"), F.col(text_col).alias("text")
        ),
        f"id {kind}, node long, fixed {_SPANS}, added {_SPANS}",
        ["id", "node", "text"],
        spans_of,
        lambda: sent.value if sent else {},
    )
    if sent is None:
        joined = _joined_spans(docs, text_col, patterns)
        found = found.drop("added").join(joined, "node", "left")
        found = found.withColumn("added", F.coalesce("added", F.array().cast(_SPANS)))
    return found.select(F.col("id").alias(id_col), "fixed", "added")


def redact(docs: DataFrame, text_col: str = "text", **learning) -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by its kind, as ``<EMAIL>``.

    All columns stay in place. Overlapping spans become one mark of the first one's kind.
    """
    if docs.schema[text_col].dataType.simpleString() != "string":
        raise TypeError(f"{text_col} must be a string column")
    patterns = stored(learn_patterns(docs, text_col, **learning), "pii-patterns")
    sent = _few(patterns)
    given = docs
    if sent is None:
        joined = _joined_spans(docs, text_col, patterns)
        joined = joined.select(F.col("node").alias(_NODE), F.col("added").alias(_ADDED))
        given = docs.withColumn(_NODE, F.xxhash64(text_col)).join(joined, _NODE, "left").drop(_NODE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            added = [None] * batch.num_rows if sent else batch.column(_ADDED).to_pylist()
            texts = []
            for raw, spans in zip(texts_of(batch, text_col), added, strict=True):
                text = None if raw is None else raw.decode()
                if text is not None and sent:
                    text = masked(text, sent.value)
                elif text is not None:
                    more = [(s["start"], s["end"], s["kind"]) for s in spans or []]
                    text = _marked(text, fixed_spans(text) + more)
                texts.append(text)
            at = batch.schema.get_field_index(text_col)
            batch = batch.set_column(at, text_col, pa.array(texts, batch.schema.field(at).type))
            yield batch if sent else batch.drop_columns([_ADDED])

    return given.mapInArrow(run, docs.schema)


def masked(text: str, patterns: dict[str, tuple[str, float]]) -> str:
    fixed = fixed_spans(text)
    return _marked(text, fixed + discovered(text, fixed, patterns))


def _marked(text: str, spans: list[Span]) -> str:
    spans = sorted(spans, key=lambda s: (s[0], -s[1]))
    parts, free = [], 0
    for start, end, kind in spans:
        if start >= free:
            parts += [text[free:start], f"<{kind.upper()}>"]
        free = max(free, end)
    return "".join([*parts, text[free:]])


