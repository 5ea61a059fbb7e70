"""Subtitle cues as messages: style tags stripped, speaker split off, time put on a date.

Defined results: a cue without a readable ``h:mm:ss`` time or with nothing left to say gives no row; hours
beyond 23 stay as they are; with ``speaker`` given no prefix is split off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import BLANKS, strip

# fixed values: the unknown speaker, the prefix of a speaker, the time of a cue
UNKNOWN = "(未知)"
SPEAKER = f"^{BLANKS}*([^：:（(]{{1,16}}){BLANKS}*[：:]{BLANKS}*([^\\n]+)$"
CLOCK = r"^(\d+):(\d{2}):(\d{2})"


def without_tags(body: Column) -> Column:
    c = F.regexp_replace(body, r"\{[^}]*\}", "")
    return strip(F.regexp_replace(c, r"\\[Nn]", " "))


def stamped(raw: Column, date: str) -> Column:
    """``date hh:mm:ss``, or an empty string."""
    t = strip(raw)
    hour = F.regexp_replace(F.regexp_extract(t, CLOCK, 1), "^0+(?=.)", "")
    padded = F.when(F.length(hour) < 2, F.lpad(hour, 2, "0")).otherwise(hour)
    return F.when(t.rlike(CLOCK), F.concat(F.lit(date), F.lit(" "), padded, F.lit(":"), F.regexp_extract(t, CLOCK, 2), F.lit(":"), F.regexp_extract(t, CLOCK, 3))).otherwise("")


def cue_messages(cues: DataFrame, date: str = "2024-01-01", speaker: str = "", raw: str = "raw_time", body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep.., ts_raw, sender, content)."""
    text = F.coalesce(F.col(body), F.lit(""))
    split = text.rlike(SPEAKER) if not speaker else F.lit(False)
    sender = F.when(split, strip(F.regexp_extract(text, SPEAKER, 1))).otherwise(speaker or UNKNOWN)
    content = F.when(split, strip(F.regexp_extract(text, SPEAKER, 2))).otherwise(text)
    rows = cues.select(*keep, stamped(F.coalesce(F.col(raw), F.lit("")), date).alias("ts_raw"), sender.alias("sender"), content.alias("content"))
    return rows.where((F.col("ts_raw") != "") & (F.col("content") != ""))
