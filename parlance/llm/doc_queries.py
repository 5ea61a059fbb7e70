"""Queries of the text problems over documents: 7 (containers), 8 (leaks), 9 (residue)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm import leaks, packing, residue
from parlance.runtime import table

CAPACITY = 2048


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    """A container for every document that isn't blank; ``piece`` counts the parts of those too long for one."""
    return packing.pack(packing.token_counts(table(spark, d, "documents"), "doc_id", "text"), CAPACITY)


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """Per container: items and tokens."""
    return p7_packed(spark, d).groupBy("container").agg(F.count("*").alias("n_items"), F.sum("n_tokens").alias("n_tokens"))


def eval_items(spark: SparkSession, d: str) -> list[tuple[int, str]]:
    """The held-out items: a fixed table."""
    return [(r.item_id, r.text) for r in table(spark, d, "eval_items").select("item_id", "text").collect()]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Each document that holds a test item: the share of its words found in order, and with swapped ones held."""
    return leaks.leaked(table(spark, d, "documents"), "doc_id", "text", eval_items(spark, d))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_shares(spark, d).select("doc_id", "item_id")


def p9_residue(spark: SparkSession, d: str) -> DataFrame:
    """The documents with residue, and whether a rule told so or only a near-duplicate passage."""
    return residue.residue(table(spark, d, "documents"), "doc_id", "text")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_residue(spark, d).select("doc_id").distinct()


def queries():
    return {q.__name__: q for q in (p7_packed, p7_containers, p8_found, p8_shares, p9_found, p9_residue)}


def oracle_sql():
    return {}
