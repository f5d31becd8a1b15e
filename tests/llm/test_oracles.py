"""Corpus queries against their DuckDB SQL."""

import os

import pytest

import __spark_entry__ as e
from ordermart.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{os.path.join(SF, f'{table}.parquet')}')")
    cur = con.execute(e.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    want = sorted((tuple(r) for r in cur.fetchall()), key=str)
    df = e.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted((tuple(r) for r in df.select(*names).collect()), key=str) == want and want
