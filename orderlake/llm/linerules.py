"""Line-first cleaning: rules on single lines, then the document by what they leave of it.

DataFrame functions alone, inside each row: nothing is shuffled and nothing learned. A line with
a word is judged by three rules, the first that fires names it:

- navigation: four or more short items between separators, or nothing but words of menus;
- boilerplate: a line of up to 300 characters with a phrase of page furniture;
- punctuation: no sentence mark at its end, or marks and symbols where letters should be.

Failing lines go. A document goes with them if too little of its text is left, if it has fewer
than 20 words, or if over 30 % of its words lie in eight-word windows that it holds twice.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # per cent of the words
MIN_LEFT = 50  # per cent of the word characters that the lines which stay must hold
BLANKS = " \t\n\x0b\x0c\r"
BLANK = r"\x20\x09-\x0D"  # the same, as a class of a regular expression
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•·"
ITEM_CHARS = 30  # a menu's items are no longer than this on average
MARKS = r"#*$%&|<>{}\[\]\\~^=_+@!?"  # of a line's characters, an eighth at most
FEW_MARKS = 5  # as many never make a line noise
PHRASE_CHARS = 300
MENU_CHARS = 120
RULES = ("navigation", "boilerplate", "punctuation")
_END = r"[.!?:;…。！？।؟۔][)\]}\"'»”’›]*$"
_MENU = (
    r"(?i)^(?:(?:home|menu|search|about(?: us)?|contact(?: us)?|log ?in|log ?out|sign ?in|sign ?up"
    r"|register|help|faq|site ?map|next(?: page)?|previous(?: page)?|back to top|read more|more"
    r"|share|print|skip to (?:main )?content)(?:[^a-z]+|$))+$"
)
_PHRASES = (
    "cookie policy", "cookie settings", "cookie notice", "uses cookies", "use cookies",
    "accept cookies", "accept all cookies", "privacy policy", "terms of use", "terms of service",
    "terms and conditions", "all rights reserved", "enable javascript", "lorem ipsum",
    "subscribe to our newsletter", "subscribe to the newsletter", "click here",
    "powered by wordpress", "share this page", "share this post", "share on facebook",
    "share on twitter",
)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _chars_in(text: Column, chars: str) -> Column:
    """How many characters of a text are in a regular expression's class."""
    return F.regexp_count(text, F.lit(f"[{chars}]"))


def word_chars(text: Column) -> Column:
    """Code points of a text that belong to words."""
    return F.length(text) - _chars_in(text, BLANK)


def _paired(hashes: Column, step: int) -> Column:
    """Each hash with the one ``step`` places on, as one; the last ``step`` have no partner."""
    return F.transform(
        F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - step, F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get(hashes, i + step)),
    )


def _windows(words: Column, window: int) -> Column:
    """A hash (64 bits) of every run of ``window`` words, put together from runs of 1, 2, 4, ...
    words, the last two of which may overlap."""

    def grown(hashes: Column, width: int) -> Column:
        if width == window:
            return hashes
        step = min(width, window - width)
        return _bound(_paired(hashes, step), lambda h: grown(h, width + step))

    return _bound(F.transform(words, lambda w: F.xxhash64(w)), lambda h: grown(h, 1))


def _covered(windows: Column, window: int) -> Column:
    """Words in windows that occur twice or more: sorted by hash, equal neighbours, then places."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = _bound(
        placed,
        lambda s: F.transform(
            F.filter(
                F.transform(
                    s,
                    lambda x, k: F.struct(
                        x["i"].alias("i"),
                        (
                            F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                            | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
                        ).alias("found"),
                    ),
                ),
                lambda x: x["found"],
            ),
            lambda x: x["i"],
        ),
    )
    return F.aggregate(
        F.array_sort(twice),
        F.struct(F.lit(-window).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(
            i.alias("last"), (a["n"] + F.least(F.lit(window), i - a["last"])).alias("n")
        ),
        lambda a: a["n"],
    )


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words inside ``window``-word windows found twice or more, the first included."""
    return _bound(
        _windows(words, window),
        lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), _covered(w, window)).otherwise(
            F.lit(0).cast("long")
        ),
    )


def _count_of(judged: Column, rule: str) -> Column:
    return F.size(F.filter(judged, lambda j: j["rule"].eqNullSafe(F.lit(rule))))


def failed_rule(line: Column) -> Column:
    """The first rule that a line breaks; null for one that passes or has no word. The line comes
    without blanks at its ends."""
    items = _chars_in(line, SEPARATORS) + 1
    menu = ((items >= 4) & (F.length(line) <= ITEM_CHARS * items)) | (
        (F.length(line) <= MENU_CHARS) & line.rlike(_MENU)
    )
    phrase = (F.length(line) <= PHRASE_CHARS) & _bound(
        F.lower(line),
        lambda low: reduce(operator.or_, [F.contains(low, F.lit(p)) for p in _PHRASES]),
    )
    marks = _chars_in(line, MARKS)
    unsaid = ~F.right(line, F.lit(8)).rlike(_END) | (
        (marks > FEW_MARKS) & (8 * marks > F.length(line))
    )
    return (
        F.when(line == "", None)
        .when(menu, "navigation")
        .when(phrase, "boilerplate")
        .when(unsaid, "punctuation")
    )


def clean_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    min_words: int = MIN_WORDS,
    max_repeated: int = MAX_REPEATED,
    min_left: int = MIN_LEFT,
) -> DataFrame:
    """Per row of ``docs``: (id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines, n_navigation, n_boilerplate, n_punctuation, left_chars: all long; base_failed, kept:
    boolean; cleaned: string).

    Words lie between the six ASCII white-space characters, lines between newlines; a line counts
    if it has a word. n_dup_lines are lines equal to an earlier one, n_repeat_words the words in
    windows of ``window`` words found twice or more, compared by 64 bits of hash within a text.
    ``cleaned`` are the lines that pass, without blanks at their ends; left_chars its word
    characters. base_failed: fewer than ``min_words`` words, or more than ``max_repeated`` per cent
    of them repeated. kept: not base_failed, and at least ``min_left`` per cent of the word
    characters are left.

    Null and empty texts have no words, no lines and are not kept; repeated rows and null ids are
    each reported; an empty table gives no rows; only the two named columns are read. A script that
    ends its sentences without any of the known marks loses its lines.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(f"[^{BLANK}]+"), F.lit(0))
    trimmed = F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)))
    judged = F.transform(
        F.filter(trimmed, lambda line: line != ""),
        lambda line: F.struct(line.alias("line"), failed_rule(line).alias("rule")),
    )
    with_word = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    counted = docs.select(
        F.col(id_col),
        _bound(
            words,
            lambda w: F.struct(
                F.size(w).alias("n_words"),
                F.length(F.array_join(w, "")).alias("word_chars"),
                repeated_words(w, window).alias("n_repeat_words"),
            ),
        ).alias("w"),
        _chars_in(text, SYMBOLS).alias("n_symbols"),
        _bound(with_word, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).alias("n_dup_lines"),
        _bound(
            judged,
            lambda js: F.struct(
                F.size(js).alias("n_lines"),
                *[_count_of(js, rule).alias(f"n_{rule}") for rule in RULES],
                F.array_join(
                    F.transform(F.filter(js, lambda j: j["rule"].isNull()), lambda j: j["line"]), "\n"
                ).alias("cleaned"),
            ),
        ).alias("l"),
    )
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeated * F.col("n_words")
    )
    counts = ["w.n_words", "w.word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words"]
    counts += ["l.n_lines", "l.n_navigation", "l.n_boilerplate", "l.n_punctuation"]
    return (
        counted.select(
            id_col,
            *[F.col(c).cast("long").alias(c.split(".")[-1]) for c in counts],
            F.col("l.cleaned").alias("cleaned"),
        )
        .withColumn("left_chars", word_chars(F.col("cleaned")).cast("long"))
        .withColumn("base_failed", failed)
        .withColumn(
            "kept",
            ~F.col("base_failed")
            & (100 * F.col("left_chars") >= min_left * F.col("word_chars")),
        )
    )


def keep_clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, text) of the kept documents, each with the lines that passed."""
    judged = clean_lines(docs, id_col, text_col, **options).where("kept")
    return judged.select(id_col, F.col("cleaned").alias(text_col))
