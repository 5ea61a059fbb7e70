"""Visually identical text with different characters, brought to one form.

Steps: Unicode compatibility normalisation (NFKC), deletion of ignorable characters, one kind of blank, no
blanks at the ends; then, for tokens that hold letters of more than one script or letters that look like
Latin ones, a search of the token's look-alike lattice: each position offers the letter and its look-alikes,
and Viterbi takes the path with the best score of script-consistent character bigrams. The bigram counts come
from the whole collection (a table bounded by the alphabet, not by the data).

Defined results: null stays null; a text of nothing but blanks and ignorable characters becomes empty;
punctuation, case, digits and accents stay as compatibility normalisation leaves them.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# fixed values: letters of other scripts that look like a Latin letter (after compatibility normalisation)
LOOKALIKES = {
    # Cyrillic
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ї": "ï", "ј": "j", "һ": "h",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ӏ": "l", "ё": "ë", "ү": "y",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S", "І": "I",
    "Ј": "J", "Ԁ": "D", "Ԛ": "Q", "Ԝ": "W", "Ӏ": "I", "Ү": "Y", "Ё": "Ë", "Ѵ": "V",
    # Greek
    "α": "a", "ι": "i", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "γ": "y", "ό": "ó", "ί": "í", "ά": "á", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    # Armenian, Cherokee and Latin-like letters of the phonetic alphabet
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g", "զ": "q", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ı": "i",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭼ": "E", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꭲ": "T", "Ꮤ": "W", "Ꮓ": "Z",
}
# fixed values: ignorable characters beyond the category Cf: fillers, joiners and variation selectors
IGNORED = "[\\p{Cf}\\u034f\\u115f\\u1160\\u17b4\\u17b5\\u180b-\\u180f\\u3164\\uffa0\\ufe00-\\ufe0f\\U000e0100-\\U000e01ef]"
_IGNORED = regex.compile(IGNORED)
_BLANK = regex.compile(r"[\p{Zs}\t\x0b\x0c\x85  \n\r]")
_ENDS = regex.compile(r"^\s+|\s+$")
_OTHER = re.compile("[" + "".join(LOOKALIKES) + "]")
_TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}]*[" + "".join(LOOKALIKES) + r"][\p{L}\p{M}\p{N}]*")
#: letters that take part in lattices: of scripts with look-alikes; this bounds the table of bigrams
_LETTER = regex.compile(r"[\p{Script=Latin}\p{Script=Greek}\p{Script=Cyrillic}\p{Script=Armenian}\p{Script=Cherokee}]")
_RUN = regex.compile(r"[\p{Script=Latin}\p{Script=Greek}\p{Script=Cyrillic}\p{Script=Armenian}\p{Script=Cherokee}]+")
#: costs of a change of script within a token, and of each letter that isn't Latin, so that counts must speak for it
SWITCH, STAY = 7.0, 0.7


def compatible(text: str) -> str:
    """Normalised, without ignorable characters, blanks of one kind, none at the ends."""
    t = _IGNORED.sub("", text)
    t = unicodedata.normalize("NFKC", t)
    t = _IGNORED.sub("", t)
    t = unicodedata.normalize("NFC", t)
    return _ENDS.sub("", _BLANK.sub(" ", t))


def is_plain(text: str) -> bool:
    """``PLAIN`` without blanks at the ends: its own form."""
    return bool(_PLAIN.match(text)) and text[0] != " " and text[-1] != " "


@functools.cache
def script(ch: str) -> str:
    """The script of a letter, as the first word of its name."""
    return unicodedata.name(ch, "?").split()[0]


@functools.cache
def _models() -> dict[tuple[str, str], str]:
    """(script, Latin letter): the letter of the script that looks like it."""
    out: dict[tuple[str, str], str] = {}
    for other, latin in LOOKALIKES.items():
        out.setdefault((script(other), latin), other)
    return out


class Lattice:
    """Viterbi over look-alikes of a token. ``bigrams``: {(a, b): count} of lower-cased letters, "^" and "$"
    as ends; without counts only the scripts decide."""

    def __init__(self, bigrams: dict[tuple[str, str], int] | None = None):
        self.bigrams = bigrams or {}
        self.total: dict[str, int] = {}
        for (a, _), n in self.bigrams.items():
            self.total[a] = self.total.get(a, 0) + n
        self.seen: dict[str, str] = {}

    def cost(self, a: str, b: str) -> float:
        a, b = a.lower(), b.lower()
        return -math.log((self.bigrams.get((a, b), 0) + 0.05) / (self.total.get(a, 0) + 20))

    def resolve(self, token: str) -> str:
        if (known := self.seen.get(token)) is not None:
            return known
        found = "".join(self._run(m) if _LETTER.match(m) else m for m in regex.findall(_RUN.pattern + r"|[^\p{Script=Latin}\p{Script=Greek}\p{Script=Cyrillic}\p{Script=Armenian}\p{Script=Cherokee}]+", token))
        if len(self.seen) < 200_000:
            self.seen[token] = found
        return found

    def _run(self, letters: str) -> str:
        if not _OTHER.search(letters):
            return letters
        paths = {("^", ""): (0.0, "")}
        others = sorted({script(c) for c in letters} - {"LATIN"})  # a word of another script may hold Latin letters
        for ch in letters:
            options = [ch, LOOKALIKES[ch]] if ch in LOOKALIKES else [ch, *(m for s in others if (m := _models().get((s, ch))))]
            following: dict[tuple[str, str], tuple[float, str]] = {}
            for o in options:
                s = script(o)
                for (last, was), (c, text) in paths.items():
                    step = self.cost(last, o) + (SWITCH if was and s != was else 0.0) + (0.0 if s == "LATIN" else STAY)
                    key = (o, s)
                    if key not in following or c + step < following[key][0]:
                        following[key] = (c + step, text + o)
            paths = following
        # an end of the token is a bigram too
        best = min(paths.items(), key=lambda kv: (kv[1][0] + self.cost(kv[0][0], "$"), kv[1][1]))
        return best[1][1]

    def form(self, text: str) -> str:
        t = compatible(text)
        return _TOKEN.sub(lambda m: self.resolve(m[0]), t) if _OTHER.search(t) else t


@functools.cache
def _scripts() -> np.ndarray:
    """The script of each code point that takes part in lattices, from 1; 0 for all others."""
    table = np.zeros(0x20000, np.uint8)
    every = "".join(map(chr, range(len(table))))
    for k, name in enumerate(("Latin", "Greek", "Cyrillic", "Armenian", "Cherokee"), 1):
        table[[m.start() for m in regex.finditer(rf"\p{{Script={name}}}", every)]] = k
    return table


def pair_counts(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(pair of code points as a << 21 | b, count) of neighbouring lower-cased letters in runs of one script, "^"
    and "$" at their ends."""
    cps = np.frombuffer("\0".join(texts).lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    kind = _scripts()[np.minimum(cps, 0x1FFFF)]
    at = np.flatnonzero(kind)
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.diff(at, prepend=-2) != 1
    edges = np.flatnonzero(first)
    pure = np.minimum.reduceat(kind[at], edges) == np.maximum.reduceat(kind[at], edges)
    good = pure[np.cumsum(first) - 1]
    last = np.append(first[1:], True)
    before = np.where(first, ord("^"), np.concatenate([[0], cps[at][:-1]]))
    pairs = np.concatenate([before[good] << 21 | cps[at][good], cps[at][good & last] << 21 | ord("$")])
    return np.unique(pairs, return_counts=True)


def bigram_counts(df: DataFrame, column: str) -> DataFrame:
    """(a, b, n): bigrams of letters of single-script runs over all texts; partial counts by task."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[int] = Counter()
        for b in batches:
            pairs, n = pair_counts(b[column].tolist())
            total.update(dict(zip(pairs.tolist(), n.tolist())))
        yield pd.DataFrame([(chr(p >> 21), chr(p & 0x1FFFFF), n) for p, n in total.items()], columns=["a", "b", "n"])

    texts = df.select(column).where(F.col(column).rlike("[A-Za-z\\u00c0-\\u058f\\u13a0-\\u13fd]"))
    return texts.mapInPandas(count, "a string, b string, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def lattice_of(df: DataFrame, column: str) -> Lattice:
    """The lattice with the counts of a collection. The counts are of pairs of letters of five scripts: a
    few thousand rows whatever the size of the collection."""
    rows = bigram_counts(df, column).collect()
    return Lattice({(r.a, r.b): r.n for r in rows})


#: texts of these characters only, without a blank at either end, are their own form. The patterns repeat single
#: classes, never groups: Java's matcher would recurse over a group on long texts.
PLAIN = r"^[ -~\x{4e00}-\x{9fa5}\x{3001}\x{3002}\x{300a}-\x{3011}áéíóúñü¡¿ÁÉÍÓÚÑÜ]+$"
ENDS = "^ | $"
_PLAIN = re.compile(r"[ -~\u4e00-\u9fa5\u3001\u3002\u300a-\u3011áéíóúñü¡¿ÁÉÍÓÚÑÜ]+\Z")


def consistent(column: Column, lattice: Lattice) -> Column:
    """``column`` in one consistent form; plain text stays inside the JVM."""

    @F.pandas_udf(StringType())
    def form(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else lattice.form(t))

    plain = column.rlike(PLAIN) & ~column.rlike(ENDS)
    return F.when(column.isNull() | plain, column).otherwise(form(F.when(~plain, column)))
