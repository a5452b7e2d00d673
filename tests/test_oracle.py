"""Every registered query against its DuckDB oracle (sf0.001, whole tables)."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry
import oracle_queries
from tidemark.plans.queries import REGISTRY as QUERIES
from tools.check_oracle import TABLES, digest

ORACLE = oracle_queries.SQL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["repo_owner", "repo_name", "calendar_date"]
    assert df.count() > 0
