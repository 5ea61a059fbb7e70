"""Reading time stamps natively: wall-clock text to microseconds, zones to instants.

All functions are compositions of built-in expressions, independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = r"^(\d{4})-(\d{1,2})-(\d{1,2})[T ](\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?$"


def iso_micros(text: Column) -> Column:
    """An ISO-like stamp without zone as microseconds of its wall clock; seconds and fractions optional.

    The pattern admits the spelling, a cast with an explicit zone reads it, so neither the session's zone nor
    its ANSI mode matters.
    """
    short = text.rlike(r"[T ]\d{1,2}:\d{2}$")
    full = F.concat(F.translate(text, ",", "."), F.when(short, ":00Z").otherwise("Z"))
    return F.when(text.rlike(ISO), F.unix_micros(full.try_cast("timestamp")))


def to_instant(wall_us: Column, zone: Column) -> Column:
    """Wall-clock microseconds in a zone as UTC microseconds.

    A local time that occurs twice is the earlier instant; a skipped one is read with the offset before
    the change.
    """
    return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(wall_us), zone))
