"""Operator queries against their DuckDB twins."""

import duckdb
import pytest
from conftest import SF01

from lexis.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in "documents pages benchmark embeddings".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF01}/{t}.parquet'")
    df = registry.QUERIES[name](spark, SF01)
    cur = con.execute(registry.ORACLE_SQL[name])
    cols = [c[0] for c in cur.description]
    keys = sorted(cols)
    assert keys == sorted(df.columns)
    want = sorted(repr(tuple(r[cols.index(k)] for k in keys)) for r in cur.fetchall())
    assert sorted(repr(tuple(r[k] for k in keys)) for r in df.collect()) == want
