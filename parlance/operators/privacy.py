"""Privacy scan: every match of seven rules in every line, in one pass over the text.

Defined results: null texts have no lines; matches are cut to 60 characters; the hits of a line come in the
order of the rules, then of their places.
"""

from __future__ import annotations

import subprocess
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance import model


def lines_of(df: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, line_no, line), numbered from 1."""
    return df.select(key, F.posexplode(F.split(text, "\n")).alias("i", "line")).select(key, (F.col("i") + 1).alias("line_no"), "line")


def hits(lines: DataFrame, key: str) -> DataFrame:
    """(key, line_no, ord, label, pos, value). All rules are columns of one projection: one scan."""
    none = F.array().cast("array<string>")
    # the one pattern that could try every start of a long run of letters is spared lines without its mark
    possible = lambda p: F.contains(F.col("line"), F.lit("@")) if "@" in p else F.lit(True)
    rules = [
        F.struct(F.lit(k).alias("ord"), F.lit(label).alias("label"), F.when(possible(p), F.regexp_extract_all("line", F.lit(p), F.lit(0))).otherwise(none).alias("found"))
        for k, (label, _, p) in enumerate(model.PRIVACY_RULES)
    ]
    each = lines.select(key, "line_no", F.explode(F.filter(F.array(*rules), lambda r: F.size(r["found"]) > 0)).alias("r"))
    return each.select(key, "line_no", "r.ord", "r.label", F.posexplode("r.found").alias("pos", "v")).select(key, "line_no", "ord", "label", "pos", F.substring("v", 1, 60).alias("value"))


def rule_counts(found: DataFrame) -> DataFrame:
    """(label, label_en, n)."""
    english = F.create_map(*[F.lit(x) for label, en, _ in model.PRIVACY_RULES for x in (label, en)])
    return found.groupBy("label").agg(F.count("*").alias("n")).select("label", F.coalesce(F.try_element_at(english, F.col("label")), F.col("label")).alias("label_en"), "n")


def text_files(spark, root: str, ignored: DataFrame | None = None) -> DataFrame:
    """(path, content) of the files below ``root`` that are no binaries, no larger than 2 MiB, in no skipped
    directory and not among ``ignored`` (path)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    low = F.lower("path")
    keep = (F.col("length") <= model.MOST_BYTES) & ~low.rlike("(" + "|".join(s.replace(".", r"\.") for s in model.BINARY_SUFFIXES) + ")$")
    keep &= ~F.col("path").rlike("/(" + "|".join(s.replace(".", r"\.") for s in model.SKIPPED_DIRECTORIES) + ")/")
    files = files.where(keep).select("path", "content")
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    return files if ignored is None else files.join(ignored.select(plain(F.col("path")).alias("_p")), plain(files["path"]) == F.col("_p"), "left_anti")


def ignored_files(spark, root: str) -> DataFrame | None:
    """(path, without scheme) of the files below a local folder that its version control leaves out; None where it has none."""
    listing = ["git", "-C", root, "ls-files", "--others", "--ignored", "--exclude-standard", "-z"]
    try:
        out = subprocess.run(listing, capture_output=True, timeout=60, check=True).stdout.decode("utf-8", "replace")
    except (OSError, subprocess.SubprocessError):
        return None
    base = Path(root).resolve()
    return spark.createDataFrame([(str(base / p),) for p in out.split("\0") if p], "path string")


def scan_files(files: DataFrame) -> DataFrame:
    """Hits of (path, content); bytes that aren't UTF-8 are replaced."""
    return hits(lines_of(files, "path", F.make_valid_utf8(F.col("content").cast("string"))), "path")
