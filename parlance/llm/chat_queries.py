"""Queries of the text problems over chat messages: 1 (characters), 2 (runs), 3 (personal information), 4 (terms)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.stamps import iso_micros
from parlance.functions.text import strip
from parlance.llm import charforms, personal, runs, terms
from parlance.runtime import table


def consistent_messages(spark: SparkSession, d: str) -> tuple[DataFrame, charforms.Lattice]:
    """(msg_id, content, form) of all deliveries with content."""
    messages = table(spark, d, "chat_messages").where("content is not null").select("msg_id", "content")
    lattice = charforms.lattice_of(messages, "content")
    return messages.withColumn("form", charforms.consistent(F.col("content"), lattice)), lattice


def p1_consistent(spark: SparkSession, d: str) -> DataFrame:
    """Every message with content, in one consistent form, each once."""
    return consistent_messages(spark, d)[0].groupBy("msg_id").agg(F.first("form").alias("form"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    messages, lattice = consistent_messages(spark, d)
    phrases = table(spark, d, "catchphrases").where("phrase is not null")
    phrases = phrases.select("phrase_id", "phrase", charforms.consistent(F.col("phrase"), lattice).alias("form"))
    found = messages.join(phrases, "form").where("content != phrase")
    return found.select("msg_id", "phrase_id").distinct()


def message_runs(spark: SparkSession, d: str) -> DataFrame:
    messages = table(spark, d, "chat_messages")
    lattice = charforms.lattice_of(messages.where("content is not null"), "content")
    return runs.runs(messages, "src", "seq", "msg_id", "sender", "content", lattice, iso_micros(strip(F.col("time"))))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return message_runs(spark, d).where("n >= 2").select(F.col("first_id").alias("first_msg_id"), F.col("last_id").alias("last_msg_id"))


def p2_runs(spark: SparkSession, d: str) -> DataFrame:
    """One row per run, single messages included: count, and duration in seconds where both times are readable."""
    r = message_runs(spark, d)
    return r.select("src", F.col("first_id").alias("first_msg_id"), F.col("last_id").alias("last_msg_id"), F.col("n").alias("n_messages"), ((F.col("end") - F.col("start")) / 1e6).alias("seconds"))


def finder_of(spark: SparkSession, d: str) -> personal.Finder:
    """With the listed parts of names and those learned from the messages."""
    listed = [(r.part, r.kind, r.script) for r in table(spark, d, "name_parts").dropna().collect()]  # a fixed table
    messages = table(spark, d, "chat_messages")
    lattice = charforms.lattice_of(messages.where("content is not null"), "content")
    more = personal.learned_parts(messages, "content", personal.Finder(listed, lattice)).collect()
    return personal.Finder(listed + [(r.part, r.kind, r.script) for r in more], lattice)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    finder = finder_of(spark, d)
    messages = table(spark, d, "chat_messages").select("msg_id", "content", "sender")
    kinds = messages.select(
        "msg_id", personal.kinds_of(F.col("content"), finder).alias("content"), personal.kinds_of(F.col("sender"), finder, True).alias("sender")
    )
    of = lambda f: F.transform(F.col(f), lambda k: F.struct(F.lit(f).alias("field"), k.alias("kind")))
    return kinds.select("msg_id", F.explode(F.concat(of("content"), of("sender"))).alias("x")).select("msg_id", "x.field", "x.kind").distinct()


def p3_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Every message with placeholders in place of personal information, each once."""
    finder = finder_of(spark, d)
    messages = table(spark, d, "chat_messages")
    clean = messages.select("msg_id", personal.redacted(F.col("sender"), finder, True).alias("sender"), personal.redacted(F.col("content"), finder).alias("content"))
    return clean.groupBy("msg_id").agg(F.first("sender").alias("sender"), F.first("content").alias("content"))


def p4_terms(spark: SparkSession, d: str) -> DataFrame:
    """All terms with occurrences, messages and mark."""
    return terms.term_table(table(spark, d, "chat_messages").select("msg_id", "content"), "msg_id", "content")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_terms(spark, d).where("mark is not null").select("term", "mark")


def queries():
    return {q.__name__: q for q in (p1_found, p1_consistent, p2_found, p2_runs, p3_found, p3_redacted, p4_found, p4_terms)}


_TERMS = r"""
WITH m AS (SELECT DISTINCT msg_id, content FROM chat_messages WHERE content IS NOT NULL),
t AS (SELECT msg_id, unnest(regexp_extract_all(lower(content), '[\p{L}\p{N}]+')) AS term FROM m),
c AS (SELECT term, count(*) AS occurrences, count(DISTINCT msg_id) AS records FROM t GROUP BY term),
r AS (SELECT *, CASE WHEN records < 3 THEN 'rare' WHEN records >= 0.01 * (SELECT count(*) FROM m) THEN 'common' END AS mark FROM c)
"""


def oracle_sql():
    return {"p4_found": _TERMS + "SELECT term, mark FROM r WHERE mark IS NOT NULL", "p4_terms": _TERMS + "SELECT term, occurrences, records, mark FROM r"}
