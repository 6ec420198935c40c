"""The queries that SQL can express, against it."""

from pathlib import Path

import duckdb
import pytest

from weftline.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = con.sql(queries.oracle_sql()[name])
    df = queries.queries()[name](spark, DATA)
    assert sorted(df.columns) == sorted(want.columns)
    order = sorted(df.columns)
    at = [want.columns.index(c) for c in order]
    assert sorted(tuple(r[c] for c in order) for r in df.collect()) == sorted(tuple(r[i] for i in at) for r in want.fetchall())
