"""Toxicity of obfuscated texts: noisy-channel decoding, then a score of the restored words.

The channel turns letters into look-alikes, repeats them, drops in stars and pulls words apart,
into single letters or larger pieces. Decoding goes the other way: a token becomes a lattice of letters it may stand for, each with the
cost of that distortion, and the Viterbi path through the lattice under a character trigram model
of the corpus is the restored text. A token of plain letters has one path only and is not decoded.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import crc_bucket, map_rows, texts_of

TOXIC_ROWS, CLEAN_ROWS = 10_000, 100_000  # labelled rows learned from, at most about
FIT_CLEAN_ROWS = 20_000  # clean ones of these, by hash of the text, the regression is fitted on
LEXICON_WORDS = 2_000  # words the model keeps, best first
MIN_DOCS = 3  # toxic labelled texts a word must be in to be kept
MIN_WEIGHT = 2.0  # least weight of a word that is kept
THRESHOLD = 0.3
_CACHED = 300_000  # tokens a task remembers from text to text
_LETTERS = "abcdefghijklmnopqrstuvwxyz"

# Look-alikes and the letters they stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t",
    "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": _LETTERS,
}
# Costs in nats. A symbol at a token's edge may also be there for itself, a digit less likely.
_SWAP, _STAR, _REPEAT, _SINGLE, _JOIN, _SPLIT = 1.0, 3.5, 0.2, 2.0, 0.3, 4.0
_DROP, _DROP_DIGIT = 2.5, 5.0
_GAP = 3.0  # of a space between pieces of one word; pieces that pass for words stay apart
_PIECES = 6  # of one word, at most

_SYMBOLS = re.escape("".join(LOOK_ALIKES))
_SPACED = re.compile(
    rf"(?<![^\s\"'(\[{{<])(?:[a-z{_SYMBOLS}](?:[ \t]?[.\-_*/][ \t]?|[ \t]{{1,3}})){{2,}}[a-z{_SYMBOLS}]"
    r"(?![^\s.,;:?!\"')\]}>])".encode()
)
_EDGE = re.compile(rb"^[^a-z0-9@$|+(!]+|[^a-z0-9@$|+(!]+$")
_DECORATED = re.compile(rb"([^a-z0-9$])\1+$|^([^a-z0-9$])\2+|\$\$\$+$|^\$\$\$+")
_TRIPLE = re.compile(rb"([a-z])\1\1")
_DOUBLE = re.compile(rb"([a-z])\1+")
_SEPARATOR = re.compile(rb"[^a-z0-9@$|+(!*]+|\*{2,}")
_HAS_LETTER = re.compile(rb"[a-z]")
# Cyrillic and Greek letters that look like Latin ones.
LATIN_LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "α": "a", "ι": "i",
    "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
_LATIN = str.maketrans(LATIN_LOOK_ALIKES)
# Latin letters that do not decompose.
PLAIN_LATIN = {
    "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "ı": "i",
}
_MARKS = regex.compile(r"[\u0300-\u036f]")
_LOOKS = "".join(LATIN_LOOK_ALIKES)
_LOOK = regex.compile(f"[{_LOOKS}]")
_MIXED = regex.compile(
    rf"(?<![^\W\d_])(?=[a-z]*[{_LOOKS}])(?=[{_LOOKS}]*[a-z])[a-z{_LOOKS}]++(?![^\W\d_])"
)
_FOREIGN = regex.compile(r"(?V1)[\p{L}\p{M}--\p{Latin}--[\u0000-\u036f]]+")
_UNSPACED = regex.compile(
    r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
)
_REPEATED = regex.compile(r"(.)\1\1+")
_OPENING, _CLOSING = b"\"'([{<", b".,;:?!\"')]}>"
_STOPS = b".,;:?"
_RUN = re.compile(rb"([\x80-\xff]+)")
_LONG_RUN = 24  # bytes; longer runs are not remembered
# Bytes of text to letter codes, 0 for all that is no letter.
_CODES = bytes((b | 32) - 96 if chr(b).isascii() and chr(b).isalpha() else 0 for b in range(256))
_COUNTED = 1 << 20  # bytes of text whose letters are counted at once

# What a token is good for, as bits: it may begin a pulled-apart target; it may continue one; it
# may be part of a match of _SPACED; it may be one with two symbols or more in it.
_BEGINS, _CONTINUES, _LOOSE, _DENSE = 1, 2, 4, 8
_HEAD = 8  # letters of a token that are compared with the inside of targets


def _kinds(bits: int) -> bytes:
    """A character class of the token kinds with one of these bits."""
    return b"[%b]" % re.escape(bytes(kind for kind in range(16) if kind & bits))


# A match over three tokens and more has three loose ones in a row; with fewer, one is dense.
_MAY_BE_SPACED = re.compile(b"%b{3}|%b" % (_kinds(_LOOSE), _kinds(_DENSE)))
# Tokens that a match of _SPACED may begin in, end in or go through.
_MAY_BE_LOOSE = re.compile(
    rf"(?:^|[\"'(\[{{<])[a-z{_SYMBOLS}](?:[.\-_*/][a-z{_SYMBOLS}])*[.\-_*/]?$"
    rf"|^[.\-_*/]?[a-z{_SYMBOLS}](?:[.\-_*/][a-z{_SYMBOLS}])*(?:[.\-_*/.,;:?!\"')\]}}>]|$)"
    r"|^[.\-_*/]{1,2}$".encode()
)
_MAY_BE_DENSE = re.compile(
    rf"(?:^|[\"'(\[{{<])[.\-_*/]?[a-z{_SYMBOLS}][.\-_*/][a-z{_SYMBOLS}]"
    r"(?:[.\-_*/.,;:?!\"')\]}>]|$)".encode()
)


def unmarked(text: bytes) -> str:
    """Lower case without marks; look-alikes of other alphabets within Latin words are Latin."""
    plain = _MARKS.sub("", unicodedata.normalize("NFKD", text.decode()).lower())
    for letter, letters in PLAIN_LATIN.items():
        plain = plain.replace(letter, letters)
    if _LOOK.search(plain):
        plain = _MIXED.sub(lambda word: word[0].translate(_LATIN), plain)
    return plain


class _Folded(dict):
    """Runs of characters beyond ASCII to ``folded`` ones, None where they hold other alphabets.

    No run depends on what is around it: marks stay within runs, and look-alikes give None.
    """

    def __missing__(self, run: bytes) -> bytes | None:
        plain = unmarked(run)
        found = None if _FOREIGN.search(plain) else _ascii(plain)
        if len(run) <= _LONG_RUN:
            if len(self) >= _CACHED:
                self.clear()
            self[run] = found
        return found


_folded_runs = _Folded()


def _latin(text: bytes) -> bytes | None:
    """``folded`` text, or None if it has letters of other alphabets."""
    if text.isascii():
        return text.lower()
    parts = _RUN.split(text.lower())
    runs = list(map(_folded_runs.__getitem__, parts[1::2]))
    if None in runs:
        return None
    parts[1::2] = runs
    return b"".join(parts).replace(b"?", b" ")


def folded(text: bytes) -> bytes:
    """``unmarked`` text in ASCII; letters of other alphabets become spaces."""
    plain = _latin(text)
    return _ascii(unmarked(text)) if plain is None else plain


def _ascii(plain: str) -> bytes:
    return plain.encode("ascii", "replace").replace(b"?", b" ")


def foreign_words(text: bytes) -> set[str]:
    """Words in other alphabets than the Latin one, letters in threes and more taken as one.

    Scripts without spaces between words give pairs of neighbouring letters instead.
    """
    return set() if text.isascii() else _foreign(unmarked(text))


def _foreign(plain: str) -> set[str]:
    found: set[str] = set()
    for word in _FOREIGN.findall(plain):
        word = _REPEATED.sub(r"\1", word)
        if len(word) > 2 and _UNSPACED.match(word):
            found.update(word[k : k + 2] for k in range(len(word) - 1))
        else:
            found.add(word)
    return found


class LetterModel:
    """Trigram costs over letters and the word boundary (code 0)."""

    def __init__(self, counts: np.ndarray):
        tri = counts.reshape(27, 27, 27).astype(np.float64)
        uni = tri.sum(axis=(0, 1)) + 1.0
        uni /= uni.sum()
        two = tri.sum(axis=0)
        two = (two + 5.0 * uni) / (two.sum(axis=1, keepdims=True) + 5.0)
        three = (tri + 5.0 * two[None]) / (tri.sum(axis=2, keepdims=True) + 5.0)
        self.cost = (-np.log(three)).tolist()

    def best(self, lattice: list[list[tuple[str, float]]]) -> str:
        """The cheapest reading; each step lists (letters, cost of the distortion)."""
        cost, states = self.cost, {(0, 0): (0.0, "")}
        for step in lattice:
            reached: dict = {}
            for (two, one), (so_far, text) in states.items():
                for letters, distortion in step:
                    total, a, b = so_far + distortion, two, one
                    for letter in letters:
                        code = 0 if letter == " " else ord(letter) - 96
                        total += cost[a][b][code]
                        a, b = (0, 0) if code == 0 else (b, code)
                    old = reached.get((a, b))
                    if old is None or total < old[0]:
                        reached[(a, b)] = (total, text + letters)
            states = reached
        return min((c + cost[a][b][0], text) for (a, b), (c, text) in states.items())[1]


def _symbol(mark: str, run: int, fixed: bool) -> list[tuple[str, float]]:
    """What a run of one symbol may stand for; nothing at all only if it is not ``fixed``."""
    if mark in _LETTERS:
        if run == 1:
            return [(mark, 0.0)]
        return [(mark, _SINGLE if run == 2 else _REPEAT * run), (mark * 2, _REPEAT * (run - 2))]
    letters = LOOK_ALIKES.get(mark, "")
    swap = _STAR if mark == "*" else _SWAP
    options = [(letter, swap + _REPEAT * (run - 1)) for letter in letters]
    if run > 1 and mark != "*":
        options += [(letter * 2, swap + _REPEAT * (run - 2)) for letter in letters]
    if not fixed or not options:
        options.append(("", _DROP_DIGIT if mark.isdigit() or mark in "@$" else _DROP))
    return options


def _runs(text: str) -> list[tuple[str, int]]:
    found: list[tuple[str, int]] = []
    for mark in text:
        if found and found[-1][0] == mark:
            found[-1] = (mark, found[-1][1] + 1)
        else:
            found.append((mark, 1))
    return found


def decode_token(model: LetterModel, token: str, whole: bool = False) -> str:
    """The best reading; if ``whole``, of those in which symbols at the edges are letters too."""
    runs = _runs(token)
    last = len(runs) - 1
    return model.best([_symbol(m, n, whole or 0 < k < last) for k, (m, n) in enumerate(runs)])


def is_one_word(model: LetterModel, pieces: list[str], join: float, split: float) -> bool:
    """Whether pieces read cheaper as one word: each gap is closed or stays a word boundary."""
    lattice: list[list[tuple[str, float]]] = []
    for piece in pieces:
        if lattice:
            lattice.append([("", join), (" ", split)])
        lattice += [[(letter, 0.0)] for letter in piece]
    return " " not in model.best(lattice)


def decode_spaced(model: LetterModel, text: str) -> str:
    """Single symbols with separators between: each gap is closed or stays a word boundary."""
    parts = [p for p in re.split(r"[ \t.\-_/]+", text) if p]
    lattice = []
    for k, part in enumerate(parts):
        if k:
            lattice.append([("", _JOIN), (" ", _SPLIT)])
        lattice.append(_symbol(part[0], 1, 0 < k < len(parts) - 1))
    return model.best(lattice)


class _Remembered(dict):
    """What a function gives for tokens."""

    def __init__(self, find: Callable):
        super().__init__()
        self.find = find

    def __missing__(self, token: bytes):
        found = self[token] = self.find(token)
        return found


class Restorer:
    """The distinct words of a text after decoding; remembers tokens it has seen.

    ``targets`` are words worth a closer look: a token of plain letters with doubled ones is
    decoded if it could be one of them, and they are also looked for inside pulled-apart words,
    which may have run into a neighbour. Neighbouring pieces that make up one of them are that
    word if the letter model reads them cheaper joined than apart. With ``only_targets`` other
    words are left out.
    """

    def __init__(
        self, model: LetterModel, targets: tuple[str, ...] = (), only_targets: bool = False
    ):
        self.model = model
        self.told = _Remembered(self.learn)  # words of tokens
        self.dull: set[bytes] = set()  # tokens without a target, kept here if only targets count
        self.kinds: dict[bytes, int] = {}  # of tokens that are of any
        self.cores: dict[bytes, bytes] = {}  # letters of tokens that begin or continue a target
        self.only = frozenset(targets) if only_targets else None
        self.targets = [w for w in targets if len(w) > 3]
        self.squeezed = {_DOUBLE.sub(rb"\1", w.encode()) for w in targets}
        self.whole = {w.encode() for w in self.targets if w.isascii() and w.isalpha()}
        self.heads = {w[:k] for w in self.whole for k in range(1, len(w))}
        self.parts = self.heads | self.whole
        self.inside = {
            w[at : at + k]
            for w in self.whole
            for at in range(1, len(w))
            for k in range(1, _HEAD + 1)
        }

    def piece(self, piece: bytes) -> tuple[str, ...]:
        if piece.isalpha():
            single = _DOUBLE.sub(rb"\1", piece)
            if single == piece or (single not in self.squeezed and not _TRIPLE.search(piece)):
                return (piece.decode(),)
        elif not _HAS_LETTER.search(piece):
            return ()
        word = piece.decode()
        best = decode_token(self.model, word)
        if word[0].isalpha() and word[-1].isalpha():
            return (best,)
        return (best, decode_token(self.model, word, whole=True))

    def spaced(self, text: str) -> list[str]:
        decoded = decode_spaced(self.model, text)
        return decoded.split() + [w for w in self.targets if w in decoded]

    def learn(self, token: bytes) -> tuple[str, ...]:
        """The words of a token that count; its kind and letters are noted."""
        words, core = self.read(token)
        kind = 0
        if self.heads and core:
            if core in self.heads and token[-1] not in _CLOSING:
                kind |= _BEGINS
            if core[:_HEAD] in self.inside and token[0] not in _OPENING:
                kind |= _CONTINUES
            if kind:
                self.cores[token] = core
        word = token.strip(_STOPS)
        if len(word) < 2 or not word.isalpha():
            if _MAY_BE_LOOSE.search(token):
                kind |= _LOOSE
            if _MAY_BE_DENSE.search(token):
                kind |= _DENSE
        if kind:
            self.kinds[token] = kind
        if self.only is None:
            return words
        return tuple([word for word in words if word in self.only])

    def read(self, token: bytes) -> tuple[tuple[str, ...], bytes]:
        """The words of a token, and its letters if it is one piece."""
        word = token if token.isalpha() else token.strip(_STOPS)
        if word.isalpha():
            words = self.piece(word)
            return words, word if token[0] == word[0] else words[-1].encode()
        body = _EDGE.sub(b"", _DECORATED.sub(b"", token))
        if not _HAS_LETTER.search(body):
            return (), b""
        core = token.lstrip(_OPENING).rstrip(_CLOSING)
        if not core.isalpha():
            core = b""
        pieces = [p for p in _SEPARATOR.split(body) if p]
        if len(pieces) > 2 and all(len(p) == 1 for p in pieces):
            return tuple(self.spaced(" ".join(p.decode() for p in pieces))), core
        read = [self.piece(p) for p in pieces]
        if len(read) == 1:
            return read[0], core or read[0][-1].encode()
        words = tuple(word for found in read for word in found)
        first = [found[0] for found in read if found]
        if len(first) > 1 and (joined := "".join(first)).encode() in self.whole:
            if is_one_word(self.model, first, _JOIN, _SPLIT):
                words = (*words, joined)
        return words, core

    def joined(self, tokens: list[bytes], kinds: bytes) -> set[str]:
        """Targets that neighbouring pieces of a text make up."""
        found: set[str] = set()
        heads, parts, cores = self.heads, self.parts, self.cores
        bits = np.frombuffer(kinds, dtype=np.uint8)
        places = np.flatnonzero((bits[:-1] & _BEGINS > 0) & (bits[1:] & _CONTINUES > 0)).tolist()
        for at in [k for k in places if cores[tokens[k]] + cores[tokens[k + 1]] in parts]:
            text = cores[tokens[at]]
            for end in range(at + 1, min(at + _PIECES, len(tokens))):
                if not kinds[end] & _CONTINUES or tokens[end - 1][-1] in _CLOSING:
                    break
                text += cores[tokens[end]]
                if text in self.whole:
                    pieces = [cores[token].decode() for token in tokens[at : end + 1]]
                    if is_one_word(self.model, pieces, _GAP, 0.0):
                        found.add(text.decode())
                if text not in heads:
                    break
        return found

    def words(self, text: bytes | None) -> set[str]:
        # between texts, as what is noted serves a whole text
        if len(self.told) + len(self.dull) >= _CACHED:
            for noted in (self.told, self.dull, self.kinds, self.cores):
                noted.clear()
        text, found = text or b"", set()
        plain = _latin(text)
        if plain is None:
            letters = unmarked(text)
            plain, found = _ascii(letters), _foreign(letters)
        tokens = plain.split()
        telling = set(tokens)
        if self.only is not None:
            telling -= self.dull
            for token in [token for token in telling if not self.told[token]]:
                del self.told[token]
                self.dull.add(token)
                telling.remove(token)
        found.update(chain.from_iterable(map(self.told.__getitem__, telling)))
        kinds = bytes(map(self.kinds.get, tokens, repeat(0)))
        if _MAY_BE_SPACED.search(kinds):
            for match in _SPACED.finditer(plain):
                found.update(self.spaced(match[0].decode()))
        if self.heads:
            found |= self.joined(tokens, kinds)
        return found if self.only is None else found & self.only


def restore(model: LetterModel, text: str) -> str:
    """The text with every obfuscated token decoded, in lower case and without punctuation."""
    restorer = Restorer(model)
    plain = _SPACED.sub(
        lambda m: decode_spaced(model, m[0].decode()).encode(), folded(text.encode())
    )
    return " ".join(w for t in plain.split() for w in restorer.read(t)[0][:1])


def letter_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Trigram counts over all texts: at most 27^3 sums reach the driver, whatever the input."""

    def counted(texts: list[bytes]) -> np.ndarray:
        codes = (b"  " + b" ".join(texts) + b" ").translate(_CODES)
        codes = np.frombuffer(codes, dtype=np.uint8)
        # behind a boundary nothing is remembered
        codes = codes[(codes > 0) | np.append(True, codes[:-1] > 0)]
        codes = np.append(np.uint8(0), codes).astype(np.int16)
        one, two = codes[1:-1], codes[:-2] * (codes[1:-1] > 0)
        return np.bincount(two * 729 + one * 27 + codes[2:], minlength=27**3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(27**3, dtype=np.int64)
        held, size = [], 0
        for batch in batches:
            for text in texts_of(batch, "text"):
                if text:
                    held.append(folded(text))
                    size += len(text)
                if size >= _COUNTED:
                    total += counted(held)
                    held, size = [], 0
        total += counted(held)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(total[seen])], names=["code", "n"]
        )

    rows = (
        docs.select(F.col(text_col).alias("text"))
        .mapInArrow(run, "code long, n long")
        .groupBy("code")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros(27**3, dtype=np.int64)
    for row in rows:
        counts[row["code"]] = row["n"]
    return counts


def _weight(bad: float, good: float, all_bad: float, all_good: float) -> float:
    """Log odds of a word in toxic texts, less one standard error."""
    odds = math.log((bad + 0.5) / (all_bad + 1)) - math.log((good + 0.5) / (all_good + 1))
    return odds - math.sqrt(1 / (bad + 0.5) + 1 / (good + 0.5))


def _features(weights: list[float]) -> tuple[float, float, float]:
    """The strongest word, the sum of all, and how many there are."""
    spoke = [w for w in weights if w > 0]
    return max(spoke, default=0.0), min(sum(spoke), 30.0), math.log1p(len(spoke))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Ridge logistic regression on standardised features; returns [constant, slopes...].

    Newton steps, halved until the penalised loss falls; the constant is not penalised.
    """
    middle, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    x = np.column_stack([np.ones(len(x)), (x - middle) / spread])
    ridge = np.array([1e-9, *[penalty] * (x.shape[1] - 1)])

    def loss(beta: np.ndarray) -> float:
        z = x @ beta
        return float((np.logaddexp(0, z) - y * z).sum() + 0.5 * (ridge * beta * beta).sum())

    beta = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        slope = x.T @ (p - y) + ridge * beta
        step = -np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), slope)
        size, now = 1.0, loss(beta)
        while size > 1e-9 and loss(beta + size * step) > now + 1e-4 * size * float(slope @ step):
            size /= 2
        beta = beta + size * step
        if np.abs(size * step).max() < 1e-9:
            break
    slopes = beta[1:] / spread
    return np.array([beta[0] - float(slopes @ middle), *slopes])


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(text, toxic) of labelled ids, both labels thinned by hash at one rate.

    The rate leaves about TOXIC_ROWS and CLEAN_ROWS rows at most, so what is learned has the
    natural share of toxic texts at every size. The ids, bounded by that, are sent to all tasks.
    """
    marked = labels.where("toxic in (0, 1)").groupBy(id_col).agg(F.max("toxic").alias("toxic"))
    labelled = marked.select(F.col(id_col).alias("id"), "toxic").where("id is not null")
    rows = {row["toxic"]: row["count"] for row in labelled.groupBy("toxic").count().collect()}
    rate = min(1.0, TOXIC_ROWS / rows.get(1, 1), CLEAN_ROWS / rows.get(0, 1))
    unit = F.shiftrightunsigned(F.xxhash64("id"), 11) / float(1 << 53)
    chosen = labelled.where(unit < rate)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("text", "toxic").distinct()


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> dict:
    """{counts, lexicon, beta}: letter model, weights of words, regression over a text's weights.

    ``labels`` has ``id_col`` and ``toxic`` (0 or 1; other values are ignored, 1 wins over 0) of the
    rows to learn from. The letter model counts all of ``docs``. A word's weight is its log odds of
    being in a toxic text, less one standard error, among distinct texts; for the regression each
    text is weighed with counts that leave it out. Both hold for the natural ratio of the classes,
    so the limits on words and the score mean the same at every size. Without a label of either
    kind every text scores the same.
    """
    counts = letter_counts(docs, text_col)
    sample = _sample(docs, labels, id_col, text_col)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(LetterModel(counts))
        seen = Counter(), Counter()  # texts of either label, by word

        def told() -> Iterator[pa.RecordBatch]:
            for toxic, texts in enumerate(seen):
                n = pa.array(list(texts.values()), pa.int64())
                none = pa.array(np.zeros(len(texts), dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(texts), pa.string()), *((none, n) if toxic == 0 else (n, none))],
                    names=["word", "bad", "good"],
                )
                texts.clear()

        for batch in batches:
            for toxic, text in zip(
                batch.column("toxic").to_pylist(), texts_of(batch, "text"), strict=True
            ):
                seen[toxic].update(restorer.words(text))
                if len(seen[toxic]) >= _CACHED:
                    yield from told()
        yield from told()

    schema = "word string, bad long, good long"
    seen = (
        sample.select("text", F.col("toxic").cast("int"))
        .mapInArrow(words, schema)
        .groupBy("word")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .where(f"bad >= {MIN_DOCS}")
    )
    texts = {row["toxic"]: row["count"] for row in sample.groupBy(F.col("toxic").cast("int").alias("toxic")).count().collect()}
    bad, good = texts.get(1, 0), texts.get(0, 0)
    if bad < MIN_DOCS or not good:
        return {"counts": counts, "lexicon": {}, "beta": [-2.0, 0.0, 0.0, 0.0]}
    odds = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))
    error = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    best = (
        seen.where("word != ''")
        .select("word", "bad", "good", (odds - error).alias("weight"))
        .where(f"weight > {MIN_WEIGHT}")
        .orderBy(F.desc("weight"), "word")
        .limit(LEXICON_WORDS)
    )
    kept = {row["word"]: (row["bad"], row["good"]) for row in best.collect()}

    def one(restorer, toxic, text):
        pairs = [kept[w] for w in restorer.words(text)]
        rest = (bad - toxic, good - 1 + toxic)
        # a word found only with the words to look for was not counted for this text
        left = [(max(b - toxic, 0), max(g - 1 + toxic, 0)) for b, g in pairs]
        return toxic, *_features([_weight(b, g, *rest) for b, g in left])

    # toxic texts all stay; thinning the clean ones moves the constant only, by the log of the rate
    rate = min(1.0, FIT_CLEAN_ROWS / good)
    unit = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 11) / float(1 << 53)
    fitted = sample.where((F.col("toxic") == 1) | (unit < rate))
    found = map_rows(
        fitted.select(F.col("toxic").cast("int").alias("toxic"), "text"),
        "toxic int, a double, b double, c double",
        ["toxic", "text"],
        one,
        lambda: Restorer(LetterModel(counts), tuple(kept), only_targets=True),
    ).collect()
    rows = np.array([tuple(row) for row in found], dtype=np.float64)
    beta = _logistic(rows[:, 1:], rows[:, 0]).tolist()
    beta[0] += math.log(rate)
    lexicon = {word: _weight(b, g, bad, good) for word, (b, g) in kept.items()}
    return {"counts": counts, "lexicon": lexicon, "beta": beta}


def _setup(sent):
    """Per task: what turns a text into (score, words that spoke for toxicity)."""
    model = sent.value
    lexicon, beta = model["lexicon"], model["beta"]
    restorer = Restorer(LetterModel(model["counts"]), tuple(lexicon), only_targets=True)

    def judge(text: bytes | None) -> tuple[float, list[str]]:
        hits = sorted(restorer.words(text))
        features = _features([lexicon[w] for w in hits])
        z = beta[0] + sum(b * x for b, x in zip(beta[1:], features, strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), hits

    return judge


def score(
    docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: (id, score double, hits array<string>).

    ``hits`` are the restored words that spoke for toxicity. Null and empty texts have the score of
    a text without such words; repeated rows are each scored; an empty table gives no rows; other
    columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
        f"id {kind}, score double, hits array<string>",
        ["id", "text"],
        lambda judge, key, text: (key, *judge(text)),
        lambda: _setup(sent),
    ).withColumnRenamed("id", id_col)


def drop_toxic(
    docs: DataFrame, model: dict, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns stay."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _setup(sent)
        for batch in batches:
            keep = [judge(text)[0] < threshold for text in texts_of(batch, text_col)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def learnable(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The label rows to learn from: crc32 of the id modulo 4 is not 2."""
    return labels.where(crc_bucket(id_col, 4) != 2)


def is_held_out(id_col: str = "doc_id"):
    return F.coalesce(crc_bucket(id_col, 4) == 2, F.lit(False))
