"""All queries outside the text-corpus subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parlance.plans import events, files, ingest, style


def modules() -> list:
    return [style, ingest, files, events]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style.ngrams_top(spark, sf_dir)
