"""The driver contract: entry() runs, every registered query agrees with its
DuckDB twin (here at sf0.001; the driver checks sf0.01)."""

import math

import duckdb
import pytest
from conftest import SF001

import __spark_entry__ as E
from lexis.plans.registry import ORACLE_SQL, QUERIES

TABLES = ("documents pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else None
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "rank", "doc_id", "score"]
    assert df.count() > 0


def test_every_query_has_a_twin_or_a_brute_force_test():
    assert set(QUERIES) - set(ORACLE_SQL) == {"lsa_topk", "lsa_reference_topk", "latent_topk",
                                               "russian_stem_vocabulary"}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_duckdb(spark, con, name):
    sdf = E.queries()[name](spark, SF001)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    cols = sorted(sdf.columns)
    got = sorted(repr(tuple(norm(r[c]) for c in cols)) for r in sdf.collect())
    idx = [rel.columns.index(c) for c in cols]
    want = sorted(repr(tuple(norm(r[i]) for i in idx)) for r in rel.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"index_append", "index_reopen_bm25", "stream_ingest"}))
def test_final_plans_scan_documents_once(spark, name):
    df = QUERIES[name](spark, SF001)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    paths = df._jdf.queryExecution().executedPlan().toString()
    assert paths.count(f"{SF001}/documents.parquet") <= 1, plan
