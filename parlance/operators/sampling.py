"""Month-stratified sampling of contiguous excerpts, without a loop and reproducible.

Every month tries up to ``tries`` segments, whose start and length come from an integer hash of (seed, month,
try). A position belongs to the first try that covers it; a month stops at the try with which its quota is
reached. All of this is set-oriented: first covers and cumulative sums.

Defined results: messages without month or content are left out; a quota isn't capped by the size of the
month, so a small month is taken nearly whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.text import year_month
from parlance.operators.ordered import behind

#: of the hash: prime modulus and multipliers small enough for 64-bit products
MODULUS, A, B, C = 2_147_483_647, 48_271, 69_621, 16_807


def draw(seed: int, month_no, t, salt: int):
    """A number below MODULUS in plain integer arithmetic, of columns or of arrays."""
    x = (month_no * A + t * B + (seed * C + salt)) % MODULUS
    x = (x * A + salt) % MODULUS
    return (x * C + t) % MODULUS


def eligible(messages: DataFrame) -> DataFrame:
    """The messages that can be sampled, with ``month``. A relation with a column ``full`` needs no content."""
    full = F.col("full") if "full" in messages.columns else F.coalesce("content", F.lit("")) != ""
    return messages.withColumn("month", year_month(F.col("ts_raw"))).where((F.coalesce("month", F.lit("")) != "") & full)


def month_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("month").agg(F.count("*").alias("n"))


def quotas(totals: DataFrame, target: int, base: int) -> DataFrame:
    """(month, n, quota)."""
    all_ = totals.agg(F.sum("n").alias("all"), F.count("*").alias("months"))
    all_n, months = all_.select("all").scalar(), all_.select("months").scalar()
    weight = F.greatest(F.lit(target) - F.lit(base) * months, F.lit(1))
    return totals.withColumn("quota", F.floor(F.lit(base) + F.col("n") / all_n * weight))


def positions(rows: DataFrame) -> DataFrame:
    """``rows`` with ``pos``, 0-based within the month in order of (src, seq), and ``idx``, within the source.

    Positions are sums over blocks of the order: first within (month, src), then the offsets of the sources.
    """
    rows = behind(rows, ["src"], "seq", F.lit(1)).drop("_prev").withColumnRenamed("_before", "idx")
    inner = behind(rows, ["month", "src"], "seq", F.lit(1)).drop("_prev")
    sizes = rows.groupBy("month", "src").agg(F.count("*").alias("_n"))
    w = Window.partitionBy("month").orderBy("src").rowsBetween(Window.unboundedPreceding, -1)  # one row per source and month
    offsets = sizes.withColumn("_o", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    return inner.join(offsets, ["month", "src"]).withColumn("pos", F.col("_before") + F.col("_o")).drop("_before", "_o")


def month_number(month: Column) -> Column:
    """An integer of the month's text: its digits, or 0."""
    return F.coalesce(F.nullif(F.regexp_replace(month, "[^0-9]", ""), F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


def picked(quota: DataFrame, seg_min: int, seg_max: int, seed: int, tries: int) -> DataFrame:
    """(month, pos) of the sample, from (month, n, quota). A month is one row, and what it covers is bounded by tries
    and lengths, so each is worked out as arrays."""

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = np.arange(1, tries + 1, dtype=np.int64)
        for b in batches:
            for month, n, most, no in zip(b["month"], b["n"], b["quota"], b["no"]):
                start = draw(seed, np.int64(no), t, 1) % n
                size = np.minimum(seg_min + draw(seed, np.int64(no), t, 2) % (seg_max - seg_min + 1), n - start)
                try_ = np.repeat(t, size)
                pos = np.arange(len(try_)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
                pos, first = np.unique(pos, return_index=True)
                covered = np.cumsum(np.bincount(try_[first], minlength=tries + 1))
                stop = int(np.searchsorted(covered, most))  # the try with which the quota is reached
                yield pd.DataFrame({"month": month, "pos": pos[try_[first] <= stop]})

    return quota.select("month", "n", "quota", month_number(F.col("month")).alias("no")).mapInPandas(take, "month string, pos bigint")


def stratified_sample(messages: DataFrame, target: int = 6500, base: int = 120, seg_min: int = 20, seg_max: int = 45, seed: int = 42, tries: int = 5000) -> DataFrame:
    """The sampled rows with month and pos."""
    rows = eligible(messages)
    take = picked(quotas(month_totals(rows), target, base), seg_min, seg_max, seed, tries)
    return positions(rows).join(take, ["month", "pos"], "left_semi")


def sample_stats(messages: DataFrame, sample: DataFrame) -> DataFrame:
    """(month, total, sampled, segments): a segment ends where the next sampled row isn't the next of its source."""
    ordered = behind(sample, ["month", "src"], "seq", F.struct("idx"))
    segs = ordered.groupBy("month").agg(F.count("*").alias("sampled"), F.count_if(F.col("_prev").isNull() | (F.col("_prev.idx") != F.col("idx") - 1)).alias("segments"))
    return month_totals(eligible(messages)).withColumnRenamed("n", "total").join(segs, "month", "left").na.fill(0, ["sampled", "segments"])
