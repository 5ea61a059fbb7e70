"""Streaming forms of the profile's time sections and of sessions, an extension to the batch operators.

Input streams have (msg_id, src, sender, ts TIMESTAMP). Late data is bounded by a watermark, repeated
deliveries within it are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def once(stream: DataFrame, late: str = "1 day") -> DataFrame:
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(["msg_id"])


def hourly_volume(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """(start, sender, n) per hour."""
    return once(stream, late).groupBy(F.window("ts", "1 hour"), "sender").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "sender", "n")


def live_sessions(stream: DataFrame, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """(src, sender, start, end, n) of sessions that the watermark has closed."""
    rows = once(stream, late).where(F.trim(F.coalesce("sender", F.lit(""))) != "")
    s = rows.groupBy("src", F.trim("sender").alias("sender"), F.session_window("ts", gap)).agg(F.count("*").alias("n"))
    return s.select("src", "sender", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")
