"""Every registered query against its SQL oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF001
from fieldatlas.plans.catalog import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _canon(rows, cols):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in idx))
    return sorted(out, key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.execute(ORACLE_SQL[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(rows, df.columns) == _canon(rel.fetchall(), ocols)


def test_entry_smoke(spark):
    out = entry.entry(spark)
    assert out.columns == ["rank", "community", "num_species"]
    assert 0 < out.count() <= 10


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_in_any_plan(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
