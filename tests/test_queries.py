"""Every registered query against its SQL twin on the smallest tables."""

import glob
import os

import duckdb
import pytest

from gradeloom.plans import registry

from .conftest import SF


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    one = lambda x: repr(round(x, 8)) if isinstance(x, float) else str(x)
    return [cols[i] for i in order], sorted(tuple(one(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    sql = registry.oracle_sql().get(name)
    if sql:
        res = duck.execute(sql)
        assert got == canon([c[0] for c in res.description], res.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
