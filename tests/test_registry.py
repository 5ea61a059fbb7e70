"""Every query outside the text-corpus subpackage against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from parlance.plans import registry

D = "/root/testdata/sf0.001"
QUERIES = {k: q for m in registry.modules() for k, q in m.queries().items()}
SQL = {k: q for m in registry.modules() for k, q in m.oracle_sql().items()}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{D}/*.parquet"):
        c.execute(f"create view \"{os.path.basename(p)[:-8]}\" as select * from '{p}'")
    return c


def same(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, D)
    cols = sorted(df.columns)
    got = sorted((tuple(same(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name in SQL:
        rel = con.sql(SQL[name])
        assert sorted(rel.columns) == cols
        at = [list(rel.columns).index(c) for c in cols]
        assert got == sorted((tuple(same(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    else:
        assert got


def test_entry_and_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
