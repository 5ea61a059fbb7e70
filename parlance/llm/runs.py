"""Runs of identical or nearly identical consecutive events, collapsed into one row each.

Method: boundary-only rows. Events that differ from their predecessor are kept as starts; a lead over the
starts gives each run's end, differences of positions its count, the time of the event before the next start
its duration.

Scale: the order is cut into blocks, and one shuffle by (group, block) with one sort serves the removal of
repeated deliveries, the predecessors, the positions and the leads. Only runs that touch an edge of a block,
two rows a block at most, are shuffled once more, by group, and joined across the edges. A group that holds a
third of all rows is thus no single task.

Defined results: deliveries with the same id are one event; events at the same place are taken in the order of
their ids; an event with a null or blank sender or content is in no run and ends one; null groups, positions or
ids are left out; unreadable times give a null duration; an empty table gives no runs; extra columns are ignored.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.text import blank_to_null, is_blank
from parlance.llm.charforms import Lattice, is_plain
from parlance.llm.leaks import SPACE
from parlance.operators.ordered import BLOCK
from parlance.runtime import written


@functools.cache
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Whether a code point is a letter or digit (or parts texts), and whether it is a letter."""
    kinds = np.array([unicodedata.category(chr(cp))[0] for cp in range(SPACE)])
    kept = (kinds == "L") | (kinds == "N")
    kept[0] = True
    return kept, kinds == "L"


def bare_texts(forms: Sequence[str]) -> list[str]:
    """Lower-cased letters and digits only, a letter repeated in a row once; all texts at once."""
    if not len(forms):
        return []
    kept, letter = _classes()
    cps = np.frombuffer("\0".join(f.replace("\0", " ") for f in forms).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    low = np.minimum(cps, SPACE - 1)
    high = cps >= SPACE
    keep = kept[low]
    keep[high] = cps[high] < 0xE0000
    cps, low = cps[keep], low[keep]
    again = np.zeros(len(cps), bool)
    again[1:] = (cps[1:] == cps[:-1]) & (letter[low[1:]] | (cps[1:] >= SPACE))
    return cps[~again].tobytes().decode("utf-32-le", "surrogatepass").split("\0")


def bare(content: Column, lattice: Lattice) -> Column:
    """The bare text of ``content`` in its consistent character form."""

    @F.pandas_udf("string")
    def made(texts: pd.Series) -> pd.Series:
        given = texts.notna()
        some = texts[given]
        out = pd.Series(None, index=texts.index, dtype="object")
        out[given] = bare_texts([t if is_plain(t) else lattice.form(t) for t in some])
        return out

    return made(content)


def compared(content: Column, bare_: Column) -> Column:
    """struct<content, bare> that tells near-identity. Equal contents have equal bare forms, so the content
    itself counts only where nothing is left of it; elsewhere it isn't carried along."""
    return F.struct(F.when(bare_ == "", content).alias("content"), bare_.alias("bare"))


def near(a: Column, b: Column, least: int = 10) -> Column:
    """Nearly identical contents, given as structs of ``compared``."""
    x, y = a["bare"], b["bare"]
    digits = lambda c: F.regexp_replace(c, r"\P{N}+", "")
    close = (F.length(x) >= least) & (F.length(y) >= least) & (F.abs(F.length(x) - F.length(y)) <= 1)
    one = F.when(close, (F.levenshtein(x, y, 1) == 1) & (digits(x) == digits(y))).otherwise(False)
    return F.when((x == "") | (y == ""), F.coalesce(a["content"] == b["content"], F.lit(False))).otherwise((x == y) | one)


def runs(events: DataFrame, group: str, order: str, event_id: str, actor: str, content: str, lattice: Lattice, ts: Column, block: int = BLOCK) -> DataFrame:
    """(group, first_id, last_id, n, start, end) of every run, those of one event included. ``ts``: microseconds."""
    rows = events.select(
        F.col(group).alias("_g"), F.col(order).alias("_o"), F.col(event_id).alias("_id"), ts.alias("_ts"), blank_to_null(F.col(actor)).alias("_actor"),
        F.coalesce(~is_blank(F.col(content)), F.lit(False)).alias("_full"), F.col(content).alias("_content"), F.floor(F.col(order) / block).alias("_b"),
    ).dropna(subset=["_g", "_o", "_id"])
    rows = rows.withColumn("_bare", bare(F.when(F.col("_full"), F.col("_content")), lattice))
    rows = rows.select("_g", "_o", "_b", "_id", "_ts", F.struct("_actor", F.when(F.col("_full"), compared(F.col("_content"), F.col("_bare"))).alias("what")).alias("_me"))
    pieces = written(pieces_of(rows), "pieces")
    edge = F.col("_first") | F.col("_last")
    done = pieces.where(~edge).select("_g", "first_id", "last_id", "n", "start", "end")
    return done.unionByName(across(pieces.where(edge))).withColumnRenamed("_g", group)


def alike(a: Column, b: Column) -> Column:
    """Whether an event is of one run with the one before; structs of actor and what was said."""
    return F.coalesce((a["_actor"] == b["_actor"]) & near(a["what"], b["what"]), F.lit(False))


def pieces_of(rows: DataFrame) -> DataFrame:
    """Runs within blocks; ``_first`` and ``_last`` tell that they begin or end with the block, ``_head`` and
    ``_tail`` hold the events there."""
    w = Window.partitionBy("_g", "_b").orderBy("_o", "_id")
    prev = F.lag(F.struct("_id", "_ts", "_me")).over(w)
    rows = rows.withColumn("_prev", prev).where(F.col("_prev").isNull() | (F.col("_prev._id") != F.col("_id")))
    rows = rows.withColumn("_pos", F.row_number().over(w)).withColumn("_final", F.lead("_id").over(w).isNull())
    first = F.col("_prev").isNull()
    rows = rows.withColumn("_new", first | ~alike(F.col("_prev._me"), F.col("_me")))
    kept = rows.where(F.col("_new") | F.col("_final")).select(
        "_g", "_b", "_o", "_id", "_ts", "_pos", "_new", "_final", first.alias("_first"), F.when(first, F.col("_me")).alias("_head"), F.when(F.col("_final"), F.col("_me")).alias("_tail"),
        # what ends the run before this row: the event before a start, else the event itself
        F.when(F.col("_new"), F.struct(F.col("_prev._id").alias("id"), F.col("_prev._ts").alias("ts"), (F.col("_pos") - 1).alias("pos")))
        .otherwise(F.struct(F.col("_id").alias("id"), F.col("_ts").alias("ts"), F.col("_pos").alias("pos"))).alias("_end"),
    )
    kept = kept.withColumn("_next", F.lead(F.struct("_end", "_new", "_tail")).over(w)).where("_new")
    end = F.coalesce(F.col("_next._end"), F.struct(F.col("_id").alias("id"), F.col("_ts").alias("ts"), F.col("_pos").alias("pos")))
    last = F.col("_next").isNull() | ~F.col("_next._new")
    return kept.select(
        "_g", "_b", "_o", F.col("_id").alias("first_id"), end["id"].alias("last_id"), (end["pos"] - F.col("_pos") + 1).cast("bigint").alias("n"), F.col("_ts").alias("start"), end["ts"].alias("end"),
        "_first", last.alias("_last"), "_head", F.when(last, F.coalesce(F.col("_next._tail"), F.col("_tail"))).alias("_tail"),
    )


def across(edges: DataFrame) -> DataFrame:
    """The runs at the edges of blocks, joined where one goes on in the next block."""
    w = Window.partitionBy("_g").orderBy("_b", "_o", "first_id")
    goes_on = F.col("_first") & alike(F.lag("_tail").over(w), F.col("_head"))
    runs_ = edges.withColumn("_new", F.when(goes_on, 0).otherwise(1)).withColumn("_k", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.struct("_b", "_o", "first_id")
    merged = runs_.groupBy("_g", "_k").agg(
        F.min(F.struct(place.alias("col1"), "start")).alias("_a"), F.max(F.struct(place.alias("col1"), F.col("last_id").alias("id"), F.col("end").alias("ts"))).alias("_z"), F.sum("n").alias("n"),
    )
    return merged.select("_g", F.col("_a.col1.first_id").alias("first_id"), F.col("_z.id").alias("last_id"), "n", F.col("_a.start").alias("start"), F.col("_z.ts").alias("end"))
