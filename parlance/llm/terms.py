"""Frequency of every distinct term: occurrences, records, and marks for the too rare and too common.

Method: each record emits its terms with their counts; these are combined partially by hash before the shuffle
(map-side aggregation), then occurrences and record counts are summed and the bounds applied.

Defined results: repeated deliveries (same id and text) are one record; null content is no record, blank content
a record without terms; a term in fewer than ``least`` records is ``rare``, one in at least the share
``common`` of them ``common`` (a term that is both, in a tiny collection, counts as rare), others have a null
mark; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TERM = r"[\p{L}\p{N}]+"


def term_counts(once: DataFrame, text: str) -> DataFrame:
    """(term, occurrences, records) over records that are each held once.

    A record's terms are sorted, so those of one kind stand together: each is a row that tells whether it is the first
    of its kind in the record. The partial sums of the rows are a record's counts, joined to those of the other
    records of a task before anything is shuffled; the work is that of sorting the terms of a record.
    """
    found = once.select(F.array_sort(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))).alias("f"))
    rows = found.select("f", F.posexplode("f").alias("i", "term"))
    first = (F.col("i") == 0) | (F.get("f", F.col("i") - 1) != F.col("term"))
    return rows.select("term", first.cast("bigint").alias("first")).groupBy("term").agg(F.count("*").alias("occurrences"), F.sum("first").alias("records"))


def term_table(df: DataFrame, record_id: str, text: str, least: int = 3, common: float = 0.01) -> DataFrame:
    """(term, occurrences, records, mark)."""
    rows = df.where(F.col(text).isNotNull() & F.col(record_id).isNotNull()).select(record_id, text)
    total = rows.agg(F.count_distinct(record_id)).scalar()  # shuffles the ids alone
    mark = F.when(F.col("records") < least, "rare").when(F.col("records") >= F.lit(common) * total, "common")
    return term_counts(rows.distinct(), text).select("term", "occurrences", "records", mark.alias("mark"))
