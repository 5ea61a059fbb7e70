import pytest
from pyspark.sql import functions as F

from parlance.operators.ordered import ahead, behind


@pytest.mark.parametrize("levels", [0, 1, 2, 3])
def test_neighbours_and_positions_across_blocks(spark, levels):
    rows = [("a", i * i) for i in range(40)] + [("b", 7), ("c", None), (None, 1)] + [("b", 100_000)]
    df = spark.createDataFrame(rows, "g string, o long")
    got = {(r.g, r.o): (r._prev, r._before) for r in behind(df, ["g"], "o", F.col("o"), block=8, levels=levels).collect()}
    nxt = {(r.g, r.o): r._next for r in ahead(df, ["g"], "o", F.col("o"), block=8, levels=levels).collect()}
    for g in "ab":
        os = sorted(o for x, o in rows if x == g)
        for k, o in enumerate(os):
            assert got[g, o] == (os[k - 1] if k else None, k)
            assert nxt[g, o] == (os[k + 1] if k + 1 < len(os) else None)
    assert len(got) == 42 == len(nxt)


def test_empty(spark):
    df = spark.createDataFrame([], "g string, o long")
    assert behind(df, ["g"], "o", F.col("o")).count() == 0 == ahead(df, ["g"], "o", F.col("o")).count()
