"""Benchmark decontamination: a prefix-filtered join of benchmark windows and document words.

Built from DataFrame functions alone. Every window (13 consecutive words of an item) is found
through its rarest word, the prefix an exact match cannot do without: places of such words are
picked out of the documents with the words around them, joined with the windows that have the
word as prefix, held against the position and length bounds, and compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import stored

WINDOW = 13
SLOTS = 1 << 17  # bytes of the word filter sent with each task; it only saves work
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased; null has none."""
    found = F.regexp_extract_all(
        F.coalesce(text, F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0)
    )
    return F.transform(
        found,
        lambda w: F.when(F.length(w) == F.octet_length(w), F.lower(w)).otherwise(
            F.translate(w, _UPPER, _LOWER)
        ),
    )


def _slot(word: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(slots)).cast("int")


def _filter_of(words: DataFrame, slots: int) -> Column:
    """A literal with byte 1 at the slot of every word: at most ``slots`` bytes, never misses."""
    marks = bytearray(slots)
    for row in words.select(_slot(F.col("word"), slots).alias("slot")).distinct().collect():
        marks[row["slot"]] = 1
    return F.lit(bytes(marks))


def _maybe(word: Column, marks: Column, slots: int) -> Column:
    return F.substring(marks, _slot(word, slots) + 1, F.lit(1)) == F.lit(b"\x01")


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item_id string, words array): distinct windows of every item that has words."""
    items = benchmark.select(
        F.col(id_col).cast("string").alias("item_id"), words_of(F.col(text_col)).alias("w")
    ).where("size(w) > 0")
    last = F.greatest(F.lit(0), F.size("w") - window)
    at = F.explode(F.sequence(F.lit(0), last)).alias("at")
    return items.select("item_id", "w", at).select(
        "item_id", F.slice("w", F.col("at") + 1, F.lit(window)).alias("words")
    ).distinct()


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    slots: int = SLOTS,
) -> DataFrame:
    """Per row of ``docs``: (id, text_hash, n_words, n_hit, item_ids array<string>, contaminated).

    A window is ``window`` consecutive words of an item; an item with fewer words is one window,
    an item without words none. n_hit counts document words inside any occurrence of a window,
    item_ids (sorted as strings, null ids left out) are the items with an occurring window. A
    document is contaminated if n_hit > 0 and 20 * n_hit >= n_words.

    Word frequencies are counted over all documents, so the prefix word of a window is the one
    with the fewest places to look at (ties: the smaller word, its first place in the window).
    The windows join on the prefix word without a hint; only the word filter is sent around, and
    its size is fixed. Null or empty texts have no words and no hits; an empty benchmark leaves
    all documents clean; repeated rows are each reported; only the named columns are read.
    """
    windows = stored(
        item_windows(benchmark, item_id_col, item_text_col, window), "decontam-windows"
    )
    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    marks = _filter_of(vocabulary, slots)
    known = F.filter(words_of(F.col(text_col)), lambda w: _maybe(w, marks, slots))
    counts = docs.select(F.explode(known).alias("word")).groupBy("word").agg(
        F.count("*").alias("n")
    )
    rarity = vocabulary.join(counts, "word", "left").select(
        "word", F.coalesce("n", F.lit(0)).alias("n")
    )
    placed = windows.select("item_id", "words", F.posexplode("words").alias("offset", "word"))
    rarest = (
        placed.join(rarity, "word")
        .groupBy("item_id", "words")
        .agg(F.min(F.struct("n", "word", "offset")).alias("prefix"))
        .where("prefix.n > 0")
    )
    prefixes = stored(
        rarest.select(
            F.col("prefix.word").alias("prefix"),
            F.col("prefix.offset").alias("offset"),
            F.size("words").alias("length"),
            "words",
            "item_id",
        ),
        "decontam-prefixes",
    )
    marks = _filter_of(prefixes.select(F.col("prefix").alias("word")).distinct(), slots)
    tokens = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("text_hash"),
        words_of(F.col(text_col)).alias("w"),
    )
    places = F.when(
        F.size("w") > 0,
        F.filter(
            F.sequence(F.lit(0), F.size("w") - 1),
            lambda i: _maybe(F.get("w", i), marks, slots),
        ),
    ).otherwise(F.array().cast("array<int>"))
    # the words from window - 1 before the place to window - 1 behind it, cut at the text's ends
    around = F.transform(
        places,
        lambda i: F.struct(
            i.alias("at"),
            F.get("w", i).alias("prefix"),
            F.slice(
                "w",
                F.greatest(i - (window - 1), F.lit(0)) + 1,
                i + window - F.greatest(i - (window - 1), F.lit(0)),
            ).alias("context"),
        ),
    )
    # one row that stands for the document itself; its key holds a space, so no word equals it
    itself = F.array(
        F.struct(
            F.lit(None).cast("int").alias("at"),
            F.concat(F.lit(" "), F.xxhash64("id", "text_hash").cast("string")).alias("prefix"),
            F.array().cast("array<string>").alias("context"),
        )
    )
    looked = tokens.select(
        "id",
        "text_hash",
        F.size("w").cast("long").alias("n_words"),
        F.explode(F.concat(itself, around)).alias("place"),
    ).select("id", "text_hash", "n_words", "place.at", "place.prefix", "place.context")
    start = F.col("at") - F.col("offset")
    skipped = F.greatest(F.col("at") - (window - 1), F.lit(0))
    match = (
        (start >= 0)
        & (start + F.col("length") <= F.col("n_words"))
        & (F.slice("context", start - skipped + 1, F.col("length")) == F.col("words"))
    )
    hits = (
        looked.join(prefixes, "prefix", "left")
        .where(F.col("at").isNull() | match)
        .groupBy("id", "text_hash", "n_words")
        .agg(
            F.count_if(F.col("at").isNull()).alias("copies"),
            F.collect_set(
                F.when(F.col("at").isNotNull(), F.struct(start.alias("start"), "length"))
            ).alias("found"),
            F.sort_array(F.collect_set("item_id")).alias("item_ids"),
        )
    )
    covered = F.flatten(
        F.transform(
            "found", lambda f: F.sequence(f["start"], f["start"] + f["length"] - 1)
        )
    )
    n_hit = F.size(F.array_distinct(covered)).cast("long")
    return (
        hits.select("id", "text_hash", "n_words", n_hit.alias("n_hit"), "item_ids", "copies")
        .select(
            F.col("id").alias(id_col),
            "text_hash",
            "n_words",
            "n_hit",
            "item_ids",
            ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias(
                "contaminated"
            ),
            F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
        )
        .drop("copy")
    )


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    **options,
) -> DataFrame:
    """``docs`` without the contaminated rows; all columns stay."""
    judged = decontaminate(docs, benchmark, id_col, text_col, **options)
    bad = stored(
        judged.where("contaminated")
        .select(F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash"))
        .distinct(),
        "contaminated",
    )
    same = docs[id_col].eqNullSafe(bad["_id"]) & (F.xxhash64(docs[text_col]) == bad["_hash"])
    return docs.join(bad, same, "left_anti")
