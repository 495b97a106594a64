"""The operators as registered queries over whole tables, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import (
    decontam,
    langid,
    licenses,
    linerules,
    packing,
    pii,
    repair,
    runs,
    simhash,
    substrings,
    topk,
    toxicity,
    warc,
)
from orderlake.llm.common import table
from orderlake.session import scratch

TOP_K = 5


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, toxicity.learnable(table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.is_held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back."""
    root = scratch(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), root)
    found = warc.read_archive(spark, root)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best inner products of every fiftieth vector against all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.exact_top_k(vectors, vectors.where("vec_id % 50 = 0"), TOP_K)


def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id",
        F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    starts = F.transform("base", lambda b: b["start"])
    base = F.transform("base", lambda b: b["label"])
    every = F.concat(base, F.transform("blocks", lambda b: b["label"]))
    best = F.array_max(F.transform("blocks", lambda b: b["containment"]))

    def written(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        written(base).alias("base_labels"),
        written(every).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(langid.learnable(docs).where("lang is not null"))
    return langid.identify(docs, model).select(
        "doc_id", langid.is_held_out().alias("held_out"), "lang_pred", "score"
    )


def op7_drop_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.drop_repeats(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return cut.select("doc_id", "n_words", "n_removed", digest)


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontam.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    rank = F.array(*[F.lit(kind) for kind in pii.KINDS])

    def written(spans):
        ordered = F.array_sort(
            F.transform(
                spans,
                lambda s: F.struct(
                    s["start"], F.array_position(rank, s["kind"]), s["end"], s["kind"]
                ),
            )
        )
        parts = F.transform(
            ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        )
        return F.array_join(parts, ",")

    def count(kind: str):
        return F.size(F.filter("fixed", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        F.sha2(written(F.col("fixed")).cast("binary"), 256).alias("base_sha256"),
        written(F.concat("fixed", "added")).alias("spans"),
    )


def op10_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes: bucket, batch and slot."""
    return packing.pack(table(spark, sf_dir, "documents")).rows


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, also those that the damage leaves without rows."""
    conversations = table(spark, sf_dir, "conversations")
    found = repair.repair(repair.damaged(conversations))
    made = repair.digests(found).alias("d")
    every = conversations.select("conv_id").distinct().alias("e")
    joined = every.join(found.summary.alias("s"), F.expr("e.conv_id <=> s.conv"), "left").join(
        made, F.expr("e.conv_id <=> d.conv"), "left"
    )
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "e.conv_id",
        # a span of turns beyond 64 bits stays null
        *[F.when(F.col("s.cost").isNull(), 0).otherwise(F.col(c)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )


def op12_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linerules.clean_lines(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(table(spark, sf_dir, "documents"), prepare=runs.looped)
    first = F.element_at(
        F.array_sort(
            F.transform(
                "runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"], r["period"])
            )
        ),
        1,
    )
    first = F.when(F.size("runs") > 0, first)
    line = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))

    def sha256(text):
        return F.sha2(text.cast("binary"), 256)

    found = found.withColumn("longest", first)
    length, period = -F.col("longest.shorter"), F.col("longest.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("(-1000 * longest.shorter) div longest.period").alias("exponent_milli"),
        sha256(F.array_join(line, "")).alias("runs_sha256"),
        sha256(F.col("collapsed")).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_toxicity, op2_warc, op3_exact_top_k, op4_simhash_groups, op5_licenses, op6_language, op7_drop_repeats, op8_decontam, op9_personal_data, op10_length_buckets, op11_conversation_repair, op12_line_rules, op13_periodic_runs]
    return {query.__name__: query for query in found}


# ---------------------------------------------------------------- DuckDB twins

# The digest is written in base 32 from eight pieces of 20 bits, four characters each.
_OP2 = """
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS n,
    sha1(coalesce(html, '')) AS hex
  FROM pages),
firsts AS (
  SELECT *, CASE WHEN n >= 0 THEN max(page_id) OVER (PARTITION BY payload) END AS first
  FROM hashed)
SELECT page_id, n::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda k: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, (k // 4 * 5 + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (k % 4))::BIGINT)
      & 31) + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS NULL OR page_id = first THEN NULL ELSE first END AS refers_to
FROM firsts
"""

_OP3 = f"""
WITH usable AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(256 * x::DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
  GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_inner_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id,
    row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
    vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {TOP_K}
"""

_OP7 = """
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT row, doc_id, pos, array_to_string(list_slice(w, pos + 1, pos + 13), ' ') AS phrase
  FROM (SELECT row, doc_id, w, unnest(range(len(w) - 12)) AS pos FROM docs WHERE len(w) >= 13)),
firsts AS (SELECT phrase, min(doc_id) AS first FROM windows GROUP BY phrase),
gone AS (
  SELECT row, list(DISTINCT word) AS gone FROM (
    SELECT row, unnest(range(pos, pos + 13)) AS word
    FROM windows JOIN firsts USING (phrase) WHERE first < doc_id)
  GROUP BY row),
kept AS (
  SELECT doc_id, len(w) AS n, len(coalesce(gone, [])) AS cut, CASE WHEN gone IS NULL THEN w ELSE
    list_select(w, list_sort(list_filter(range(1, len(w) + 1),
      lambda k: NOT list_contains(gone, k - 1)))) END AS k
  FROM docs LEFT JOIN gone USING (row))
SELECT doc_id, n::BIGINT AS n_words, cut::BIGINT AS n_removed,
  sha256(array_to_string(k, ' ')) AS kept_sha256
FROM kept
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP8 = f"""
WITH items AS (SELECT item_id::VARCHAR AS item_id, {_PLAIN_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n,
    array_to_string(list_slice(w, pos + 1, pos + least(13, len(w))), ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 13, 0) + 1)) AS pos
    FROM items WHERE len(w) > 0)),
docs AS (
  SELECT row_number() OVER () AS row, doc_id, {_PLAIN_WORDS} AS w FROM documents),
places AS (
  SELECT row, w, n, unnest(range(len(w) - n + 1)) AS pos
  FROM docs CROSS JOIN (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS (
  SELECT p.row, p.pos, p.n, v.item_id
  FROM (SELECT row, n, pos, array_to_string(list_slice(w, pos + 1, pos + n), ' ') AS phrase FROM places) p
  JOIN windows v ON v.n = p.n AND v.phrase = p.phrase),
covered AS (
  SELECT row, count(DISTINCT word) AS n_hit
  FROM (SELECT row, unnest(range(pos, pos + n)) AS word FROM hits) GROUP BY row),
named AS (
  SELECT row, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT row, item_id FROM hits) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (row) LEFT JOIN named USING (row)
"""

# The bucket boundaries come from the same dynamic programme, one recursion step per bucket:
# entry j of the list is [least cost of the first j lengths, boundaries that reach it].
_OP10 = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS words
  FROM documents),
pieces AS (
  SELECT doc_id, piece::INTEGER AS piece, piece * {packing.MAX_TOKENS} AS first_token,
    least({packing.MAX_TOKENS}, words - piece * {packing.MAX_TOKENS}) AS n_tokens
  FROM (SELECT doc_id, words, unnest(range(greatest(1,
      (words + {packing.MAX_TOKENS - 1}) // {packing.MAX_TOKENS}))) AS piece FROM sized)),
hist AS (
  SELECT row_number() OVER (ORDER BY n_tokens) AS j, n_tokens,
    sum(count(*)) OVER (ORDER BY n_tokens) AS rows_to,
    sum(sum(n_tokens)) OVER (ORDER BY n_tokens) AS tokens_to
  FROM pieces GROUP BY n_tokens),
ends AS (
  SELECT j, n_tokens, rows_to, tokens_to FROM hist
  UNION ALL SELECT 0, -1, 0, 0),
best AS (
  SELECT 0 AS k, 0::BIGINT AS j, 0::HUGEINT AS cost, []::BIGINT[] AS cuts
  UNION ALL
  SELECT k + 1, j, cost, cuts FROM (
    SELECT b.k, e.j, b.cost + (e.rows_to - f.rows_to) * e.n_tokens
        - (e.tokens_to - f.tokens_to) AS cost, list_append(b.cuts, e.n_tokens) AS cuts,
      row_number() OVER (PARTITION BY e.j ORDER BY b.cost + (e.rows_to - f.rows_to) * e.n_tokens
        - (e.tokens_to - f.tokens_to), b.j) AS pick
    FROM best b JOIN ends f ON f.j = b.j JOIN ends e ON e.j > b.j
    WHERE b.k < {packing.BUCKETS}) WHERE pick = 1),
chosen AS (
  SELECT cuts FROM best WHERE j = (SELECT max(j) FROM ends)
    AND k = (SELECT least({packing.BUCKETS}, max(j)) FROM ends)),
placed AS (
  SELECT p.*, len(list_filter(c.cuts, lambda x: x < p.n_tokens))::INTEGER AS bucket, c.cuts
  FROM pieces p, chosen c),
ordered AS (
  SELECT *, cuts[bucket + 1] AS boundary,
    row_number() OVER (PARTITION BY bucket ORDER BY n_tokens,
      coalesce((doc_id % {packing.SLICES} + {packing.SLICES}) % {packing.SLICES}, 0),
      doc_id NULLS FIRST, piece) - 1 AS place
  FROM placed)
SELECT doc_id, piece, first_token, n_tokens, bucket, boundary,
  place // greatest(1, {packing.TOKEN_BUDGET} // greatest(1, boundary)) AS batch,
  place % greatest(1, {packing.TOKEN_BUDGET} // greatest(1, boundary)) AS slot
FROM ordered
"""

_PHRASE_FOUND = " OR ".join(f"contains(lower(line), '{p}')" for p in linerules._PHRASES)
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_OP12 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (
  SELECT row, line AS raw, trim(line, {_BLANKS}) AS line
  FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM docs)),
passed AS (
  SELECT row, count(*) - count(DISTINCT raw) AS dups,
    sum(CASE
      WHEN items >= 4 AND length(line) <= {linerules.ITEM_CHARS} * items THEN 0
      WHEN length(line) <= {linerules.MENU_CHARS} AND regexp_matches(line, '{linerules._MENU}') THEN 0
      WHEN length(line) <= {linerules.PHRASE_CHARS} AND ({_PHRASE_FOUND}) THEN 0
      WHEN NOT regexp_matches(line, '{linerules._END.replace("'", "''")}') THEN 0
      WHEN marks > {linerules.FEW_MARKS} AND 8 * marks > length(line) THEN 0
      ELSE length(regexp_replace(line, '[{linerules.BLANK}]+', '', 'g')) END) AS chars
  FROM (SELECT *, length(line) - length(regexp_replace(line, '[{linerules.SEPARATORS}]', '', 'g')) + 1 AS items,
    length(line) - length(regexp_replace(line, '[{linerules.MARKS}]', '', 'g')) AS marks FROM lines)
  WHERE line <> '' GROUP BY row),
windows AS (
  SELECT row, pos, array_to_string(list_slice(w, pos + 1, pos + 8), ' ') AS phrase
  FROM (SELECT row, w, unnest(range(len(w) - 7)) AS pos FROM docs WHERE len(w) >= 8)),
twice AS (
  SELECT row, pos FROM (
    SELECT row, pos, count(*) OVER (PARTITION BY row, phrase) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT row, count(DISTINCT word) AS n FROM (
    SELECT row, unnest(range(pos, pos + 8)) AS word FROM twice) GROUP BY row),
counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[{linerules.SYMBOLS}]'))::BIGINT AS n_symbols,
    coalesce(dups, 0)::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    coalesce(chars, 0) AS chars
  FROM docs LEFT JOIN passed USING (row) LEFT JOIN covered USING (row))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {linerules.MIN_WORDS} OR 100 * n_repeat_words > {linerules.MAX_REPEATED} * n_words AS base_failed,
  NOT (n_words < {linerules.MIN_WORDS} OR 100 * n_repeat_words > {linerules.MAX_REPEATED} * n_words)
    AND 100 * chars >= {linerules.MIN_LEFT} * word_chars AS kept
FROM counted
"""

# crc32 byte by byte from its table; then one recursion step per row: insertions before it, the
# edit of the row, and per role state the cheapest way, ties by its letters.
_OP11 = rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
        lambda ch: ascii(ch)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS d
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM drawn),
numbered AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv, trim(text, {_BLANKS}) AS bare,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM damaged),
judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) || left(role, 1) AS pair
  FROM numbered),
counted AS (
  SELECT conv, any_value(conv_id) AS conv_id, max(i) AS n,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv),
inserts(q, after, letters, made) AS (VALUES
  (0, 0, '', []::VARCHAR[]), (0, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']),
  (1, 1, '', []), (1, 2, 'I', ['user:']), (1, 3, 'II', ['user:', 'assistant:']),
  (2, 2, '', []), (2, 3, 'I', ['assistant:']), (3, 3, '', []), (3, 2, 'I', ['user:'])),
steps(q, initial, after, role) AS (VALUES
  (0, 's', 1, NULL), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (2, 'a', 3, 'assistant'), (3, 'u', 2, 'user')),
edits AS (
  SELECT j.conv, j.i, s.q, s.after, 'K' AS letter, (fault IS NOT NULL)::INTEGER AS cost,
    [j.role || ':' || text] AS made
  FROM judged j JOIN steps s ON s.initial = left(j.role, 1) WHERE fault IS NULL OR fault = 'truncated'
  UNION ALL SELECT conv, i, q, after, 'R', 2 + (fault IS NOT NULL)::INTEGER, [s.role || ':' || text]
  FROM judged j, steps s WHERE s.role IS NOT NULL AND (fault IS NULL OR fault = 'truncated')
  UNION ALL SELECT conv, i, q, q, 'D', 3, [] FROM judged, range(4) AS states(q)),
ways AS (
  SELECT conv, 0::BIGINT AS i, 0::BIGINT AS q, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS made FROM counted
  UNION ALL
  SELECT conv, i, q, cost, audit, made FROM (
    SELECT w.conv, w.i + 1 AS i, e.after::BIGINT AS q, w.cost + 2 * length(n.letters) + e.cost AS cost,
      w.audit || n.letters || e.letter AS audit, w.made || n.made || e.made AS made,
      row_number() OVER (PARTITION BY w.conv, e.after ORDER BY w.cost + 2 * length(n.letters) + e.cost,
        w.audit || n.letters || e.letter) AS pick
    FROM ways w JOIN inserts n ON n.q = w.q
      JOIN edits e ON e.conv = w.conv AND e.i = w.i + 1 AND e.q = n.after) WHERE pick = 1),
ended AS (
  SELECT w.conv, w.cost + 2 * length(n.letters) AS cost, w.audit || n.letters AS audit,
    w.made || n.made AS made,
    row_number() OVER (PARTITION BY w.conv ORDER BY w.cost + 2 * length(n.letters), w.audit || n.letters) AS pick
  FROM ways w JOIN counted c ON c.conv = w.conv AND c.n = w.i JOIN inserts n ON n.q = w.q
  WHERE n.after IN (0, 3))
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(made, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
  LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
  LEFT JOIN ended d ON d.conv = c.conv AND d.pick = 1
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": _OP2, "op3_exact_top_k": _OP3, "op7_drop_repeats": _OP7, "op8_decontam": _OP8, "op10_length_buckets": _OP10, "op11_conversation_repair": _OP11, "op12_line_rules": _OP12}
