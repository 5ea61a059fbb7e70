"""Neighbours and positions in a long order, without putting a whole group into one task.

The order column is cut into blocks of ``block`` values; windows run within (keys, block), and only one edge
row per block goes to the next level, where the same is done with block numbers. After ``levels`` levels a
group has its length divided by block ** levels: with the defaults, ten billion rows of one group are blocks
of 65,536 rows and one edge table of 153 thousand. A group that holds a third of all rows is thus spread like
any other.

Rows must be unique in (keys, order); null keys or orders are left out; order values are integers and may
have gaps.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 65_536


def behind(df: DataFrame, keys: Sequence[str], order: str, carry: Column, weight: Column | None = None, block: int = BLOCK, levels: int = 1) -> DataFrame:
    """``df`` with ``_prev`` (``carry`` of the row before) and ``_before`` (weight of all rows before, their
    number by default)."""
    keys = list(keys)
    rows = df.dropna(subset=[*keys, order]).withColumn("_carry", carry).withColumn("_w", F.lit(1).cast("bigint") if weight is None else weight)
    b = f"_b{levels}"
    rows = rows.withColumn(b, F.floor(F.col(order) / block) if levels else F.lit(0))
    w = Window.partitionBy(*keys, b).orderBy(order)
    rows = rows.withColumn("_prev", F.lag("_carry").over(w)).withColumn("_before", F.coalesce(F.sum("_w").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    if not levels:
        return rows.drop("_carry", "_w", b)
    last, n = f"_last{levels}", f"_n{levels}"
    edges = rows.groupBy(*keys, b).agg(F.max_by("_carry", order).alias(last), F.sum("_w").alias(n))
    edges = behind(edges, keys, b, F.col(last), F.col(n), block, levels - 1)
    edges = edges.select(*keys, b, F.col("_prev").alias(last), F.col("_before").alias(n))
    rows = rows.join(edges, [*keys, b], "left")
    rows = rows.withColumn("_prev", F.coalesce("_prev", last)).withColumn("_before", F.col("_before") + F.col(n))
    return rows.drop("_carry", "_w", last, n, b)


def ahead(df: DataFrame, keys: Sequence[str], order: str, carry: Column, block: int = BLOCK, levels: int = 1) -> DataFrame:
    """``df`` with ``_next``: ``carry`` of the row after."""
    keys = list(keys)
    b = f"_b{levels}"
    rows = df.dropna(subset=[*keys, order]).withColumn("_carry", carry).withColumn(b, F.floor(F.col(order) / block) if levels else F.lit(0))
    rows = rows.withColumn("_next", F.lead("_carry").over(Window.partitionBy(*keys, b).orderBy(order)))
    if not levels:
        return rows.drop("_carry", b)
    first = f"_first{levels}"
    edges = rows.groupBy(*keys, b).agg(F.min_by("_carry", order).alias(first))
    edges = ahead(edges, keys, b, F.col(first), block, levels - 1).select(*keys, b, F.col("_next").alias(first))
    rows = rows.join(edges, [*keys, b], "left").withColumn("_next", F.coalesce("_next", first))
    return rows.drop("_carry", first, b)


def last_known(df: DataFrame, keys: Sequence[str], order: str, carry: Column, block: int = BLOCK, levels: int = 1) -> DataFrame:
    """``df`` with ``_known``: the last value of ``carry`` that isn't null among the rows before. Rows of one place
    in the order may be several; which of them comes first is then open."""
    keys = list(keys)
    b = f"_b{levels}"
    rows = df.dropna(subset=[*keys, order]).withColumn("_carry", carry).withColumn(b, F.floor(F.col(order) / block) if levels else F.lit(0))
    w = Window.partitionBy(*keys, b).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_known", F.last("_carry", True).over(w))
    if not levels:
        return rows.drop("_carry", b)
    last = f"_last{levels}"
    edges = rows.groupBy(*keys, b).agg(F.max_by(F.col("_carry"), F.when(F.col("_carry").isNotNull(), F.col(order))).alias(last))
    edges = last_known(edges, keys, b, F.col(last), block, levels - 1).select(*keys, b, F.col("_known").alias(last))
    return rows.join(edges, [*keys, b], "left").withColumn("_known", F.coalesce("_known", last)).drop("_carry", last, b)


def stretches(df: DataFrame, keys: Sequence[str], order: str, me: Column, alike: Callable[[Column, Column], Column], block: int = BLOCK) -> DataFrame:
    """(keys.., first, last, n, me): the longest stretches of rows each ``alike`` the one before (given as ``me`` of
    both); ``first`` and ``last`` are their places in the order, ``me`` that of the first row.

    One shuffle by (keys, block) serves neighbours, positions and leads; the stretches that touch an edge of a
    block, two a block at most, are joined in a second, small step.
    """
    keys, w = list(keys), Window.partitionBy(*keys, "_b").orderBy(order)
    rows = df.dropna(subset=[*keys, order]).select(*keys, order, F.floor(F.col(order) / block).alias("_b"), me.alias("_me"))
    rows = rows.withColumn("_prev", F.lag(F.struct("_me", order)).over(w)).withColumn("_pos", F.row_number().over(w)).withColumn("_final", F.lead(order).over(w).isNull())
    first = F.col("_prev").isNull()
    rows = rows.withColumn("_new", first | ~F.coalesce(alike(F.col("_prev._me"), F.col("_me")), F.lit(False)))
    end = F.when(F.col("_new"), F.struct(F.col(f"_prev.{order}").alias("at"), (F.col("_pos") - 1).alias("pos"))).otherwise(F.struct(F.col(order).alias("at"), F.col("_pos").alias("pos")))
    kept = rows.where(F.col("_new") | F.col("_final")).select(*keys, "_b", order, "_me", "_pos", "_new", first.alias("_first"), end.alias("_end"), F.when(F.col("_final"), F.col("_me")).alias("_tail"))
    kept = kept.withColumn("_next", F.lead(F.struct("_end", "_new", "_tail")).over(w)).where("_new")
    stop = F.coalesce(F.col("_next._end"), F.struct(F.col(order).alias("at"), F.col("_pos").alias("pos")))
    last = F.col("_next").isNull() | ~F.col("_next._new")
    pieces = kept.select(
        *keys, F.col(order).alias("first"), stop["at"].alias("last"), (stop["pos"] - F.col("_pos") + 1).cast("bigint").alias("n"), F.col("_me").alias("me"), "_b", "_first", last.alias("_last"),
        F.when(last, F.coalesce(F.col("_next._tail"), F.col("_tail"))).alias("_tail"),
    )
    # one more shuffle, of the stretches: those at edges by their keys, all others stay with their block
    edge = F.col("_first") | F.col("_last")
    pieces = pieces.withColumn("_p", F.when(~edge, F.col("_b")))
    w = Window.partitionBy(*keys, "_p").orderBy("_b", "first")
    goes_on = edge & F.col("_first") & F.coalesce(alike(F.lag("_tail").over(w), F.col("me")), F.lit(False))
    joined = pieces.withColumn("_new", F.when(goes_on, 0).otherwise(1)).withColumn("_k", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    merged = joined.groupBy(*keys, "_p", "_k").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"), F.min_by("me", "first").alias("me"))
    return merged.drop("_p", "_k")
