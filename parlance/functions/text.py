"""Column expressions for text: code-point based, Unicode blanks, literal counts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the 29 code points that count as blank at the ends of a text
BLANKS = r"[\t-\r\x1c-\x20\x85\xa0  -     　]"


#: the same as characters
BLANK_CHARACTERS = "".join(c for c in map(chr, range(0x3001)) if re.match(BLANKS, c))


def strip(c: Column) -> Column:
    """Without Unicode blanks at both ends."""
    return F.btrim(c, F.lit(BLANK_CHARACTERS))


def blank_to_null(c: Column) -> Column:
    """The stripped text, or null where nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def is_blank(c: Column) -> Column:
    """Whether nothing but Unicode blanks is in a text."""
    return ~c.rlike("[^" + BLANKS[1:])


def last_char(c: Column) -> Column:
    return F.right(strip(c), F.lit(1))


def count_of(text: Column, part: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("bigint")


def nonblank_lines(c: Column) -> Column:
    return F.size(F.filter(F.split(c, "\n"), lambda x: strip(x) != "")).cast("bigint")


def char_ngrams(c: Column, sizes: tuple[int, ...] = (2, 3, 4)) -> Column:
    """array<struct<n, i, gram>>: all overlapping n-grams with size and offset."""

    def of(n: int) -> Column:
        gram = lambda i: F.struct(F.lit(n).alias("n"), i.alias("i"), F.substring(c, i, F.lit(n)).alias("gram"))
        last = F.length(c) - (n - 1)
        return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), gram)).otherwise(F.array().cast("array<struct<n:int,i:int,gram:string>>"))

    return F.concat(*[of(n) for n in sizes])


def year_month(ts: Column) -> Column:
    return F.substring(ts, 1, 7)


def hour_of(ts: Column) -> Column:
    """The first ``h:mm`` in a stamp, else its characters 12-13, else null."""
    clock = F.regexp_extract(ts, r"([0-9]{1,2}):[0-9]{2}", 1)
    return F.coalesce(F.nullif(clock, F.lit("")).try_cast("int"), F.substring(ts, 12, 2).try_cast("int"))
