"""A synthetic conversation about a garden, from integer arithmetic over row numbers: the same on every run and
cluster.

Defined results: ``n`` rows in order of ``seq``, none for 0; every row has a time, a sender and a content.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.operators.ordered import BLOCK, behind
from parlance.operators.sampling import draw

# fixed values: begin, longest gap in minutes, share of the first speaker and shares of the forms, all in percent
START, LONGEST, FIRST, FORMS = "2024-03-01 20:00:00", 90, 55, (45, 17, 13, 10, 8, 7)
GROWER, NEIGHBOUR = "Isolde", "Bertrand"
PLANTS = ("beans", "quince", "sorrel", "leeks", "dahlias", "thyme", "marrow")
SPOTS = ("behind the shed", "along the wall", "in the frame")
REPORTS = ("watered", "pruned", "thinned out", "still dormant", "in bud", "half eaten", "moved", "tied up", "picked")
MARKS = ("[sun]", "[frost]", "[wind]")
SIGNS = ("🌱", "🐌", "🌧", "🍂", "🐝")
ASKS = ("any news of the {}", "shall I water the {}", "who planted the {}")


def one_of(values: Sequence[str], x: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (x % len(values) + 1).cast("int"))


def by_share(x: Column, shares: Sequence[int], columns: Sequence[Column]) -> Column:
    """One of the columns, with the probability of its share; ``x`` in [0, sum of the shares)."""
    ends = [sum(shares[: k + 1]) for k in range(len(shares))]
    return reduce(lambda rest, k: F.when(x < ends[k], columns[k]).otherwise(rest), range(len(columns) - 2, -1, -1), columns[-1])


def forms_of(a: Column, b: Column) -> list[Column]:
    """A report; a height; a place; a report with a mark; a plant with a sign; two reports."""
    plant, report = one_of(PLANTS, a), one_of(REPORTS, a)
    height = F.concat(plant, F.lit(" "), (b % 120 + 1).cast("string"), F.lit(" cm"))
    return [report, height, F.concat_ws(" ", plant, one_of(SPOTS, b)), F.concat(report, one_of(MARKS, b)), F.concat(plant, one_of(SIGNS, b)), F.concat_ws(", then ", report, one_of(REPORTS, b))]


def demo_messages(spark: SparkSession, n: int = 3000, seed: int = 42, block: int = BLOCK) -> DataFrame:
    """(src, seq, ts_raw, sender, content). The running sum of the gaps goes over blocks of the order."""
    x = lambda salt: draw(seed, F.lit(seed).cast("bigint"), F.col("seq"), salt)
    rows = spark.range(n).select(F.lit("demo").alias("src"), F.col("id").alias("seq")).withColumn("gap", x(1) % LONGEST + 1)
    rows = behind(rows, ["src"], "seq", F.lit(1), F.col("gap"), block)
    time = F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("_before") + F.col("gap")).cast("int"))
    first = x(2) % 100 < FIRST
    ask = F.replace(one_of(ASKS, x(4)), F.lit("{}"), one_of(PLANTS, x(5)))
    return rows.select(
        "src", "seq", F.date_format(time, "yyyy-MM-dd HH:mm:ss").alias("ts_raw"), F.when(first, GROWER).otherwise(NEIGHBOUR).alias("sender"),
        F.when(first, by_share(x(3) % sum(FORMS), FORMS, forms_of(x(4), x(5)))).otherwise(ask).alias("content"),
    )
