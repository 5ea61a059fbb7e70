"""Queries of the general problems: sessions (5) and time stamps (6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.stamps import iso_micros
from parlance.functions.text import blank_to_null, strip
from parlance.operators import sessions, timestamps
from parlance.plans.sql import strip as strip_sql
from parlance.runtime import erase, table, written

GAP_S = 30 * 60
#: batches of deliveries
BATCHES = 2


def chat_events(spark: SparkSession, d: str) -> DataFrame:
    """(src, sender, msg_id, ts, loaded_at): deliveries with a sender and a readable time."""
    who, ts = blank_to_null(F.col("sender")), iso_micros(strip(F.col("time")))
    rows = table(spark, d, "chat_messages").select("src", "msg_id", "loaded_at", F.explode(F.array(F.struct(who.alias("sender"), ts.alias("ts")))).alias("x"))
    return rows.select("src", "x.sender", "msg_id", "x.ts", "loaded_at").dropna(subset=["src", "sender", "msg_id", "ts"])


def session_table(spark: SparkSession, d: str) -> DataFrame:
    """All sessions, loaded in batches as the deliveries arrived: each batch is a stretch of whole days of
    ``loaded_at``, so late messages and repeated deliveries come in later batches than their neighbours."""
    events = written(chat_events(spark, d), "events")  # times are read once, for all batches
    day = F.coalesce(F.date_diff("loaded_at", F.lit("1970-01-01").cast("date")), F.lit(0))
    cuts = events.agg(F.percentile_approx(day, [k / BATCHES for k in range(1, BATCHES)]).alias("c")).first().c or []
    store = sessions.SessionTable(spark, ["src", "sender"], GAP_S)
    batch = sum((F.when(day > c, 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0))
    for k in range(len(set(cuts)) + 1):
        store.update(events.where(batch == k), "ts", "msg_id")
    erase(events)
    return store.sessions()


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return session_table(spark, d).select(F.col("first_id").alias("first_msg_id"), F.col("n").alias("n_messages"))


def p5_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Each session with its ends as seconds since 1970, and its duration."""
    s = session_table(spark, d)
    return s.select("src", "sender", F.floor(F.col("start") / 1000).alias("start_ms"), F.floor(F.col("end") / 1000).alias("end_ms"), ((F.col("end") - F.col("start")) / 1e6).alias("seconds"), F.col("n").alias("n_messages"))


FIELDS = ("time", "timestamp", "createTime")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The instants of records. A stamp without zone is in its exporter's zone and unreadable if that declares none, so
    nothing is estimated here; p6_estimated and p6_zone_violations align the evidence."""
    return timestamps.normalise(table(spark, d, "raw_records"), table(spark, d, "exporters")).select("rec_id", "utc_ms")


def p6_estimated(spark: SparkSession, d: str) -> DataFrame:
    """As p6_found, but writers who declare no zone get the history their records fit best."""
    return timestamps.normalise(table(spark, d, "raw_records"), table(spark, d, "exporters"), estimate=True)


def zone_support(spark: SparkSession, d: str) -> DataFrame:
    parsed = written(timestamps.stamps(table(spark, d, "raw_records"), table(spark, d, "exporters"), "exporter_id", FIELDS, ["rec_id", "exporter_id"]), "stamps")
    evidence = written(timestamps.aligned(parsed, "rec_id", "exporter_id"), "evidence")
    return timestamps.zone_support(evidence, parsed, "exporter_id", sorted(timestamps.available_timezones()))


def p6_zone_violations(spark: SparkSession, d: str) -> DataFrame:
    """Per exporter and offset history that agrees with some of its stamps: aligned stamps, and those that violate it."""
    return zone_support(spark, d)


def queries():
    return {q.__name__: q for q in (p5_found, p5_sessions, p6_found, p6_estimated, p6_zone_violations)}


_SESSIONS = rf"""
WITH m AS (
  SELECT DISTINCT msg_id, src, nullif({strip_sql('sender')}, '') AS sender,
    try_cast(replace(time, 'T', ' ') AS TIMESTAMP) AS ts
  FROM chat_messages),
g AS (
  SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w <= 1800000000 THEN 0 ELSE 1 END AS fresh
  FROM m WHERE ts IS NOT NULL AND sender IS NOT NULL AND src IS NOT NULL WINDOW w AS (PARTITION BY src, sender ORDER BY ts, msg_id)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY src, sender ORDER BY ts, msg_id ROWS UNBOUNDED PRECEDING) AS k FROM g)
"""


def oracle_sql():
    return {
        "p5_found": _SESSIONS + "SELECT arg_min(msg_id, (ts, msg_id)) AS first_msg_id, count(*) AS n_messages FROM s GROUP BY src, sender, k",
        "p5_sessions": _SESSIONS + """
            SELECT src, sender, epoch_ms(min(ts)) AS start_ms, epoch_ms(max(ts)) AS end_ms,
              (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds, count(*) AS n_messages FROM s GROUP BY src, sender, k""",
    }
