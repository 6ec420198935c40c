"""Every catalogued query against its SQL, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from weftline.plans import catalog

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    want = duck.sql(catalog.ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    order = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=str)
    at = [want.columns.index(c) for c in order]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)


def test_fold_covers_all_parts(spark):
    n = catalog.QUERIES["er_canonical"](spark, DATA)
    assert n.count() == catalog.QUERIES["er_components"](spark, DATA).select("component").distinct().count()


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
