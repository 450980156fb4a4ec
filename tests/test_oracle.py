"""Registered queries against their DuckDB twins on the smallest test tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from compare import TABLES, digest  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

from dimstar.queries import REGISTRY  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    s_rows, d_rows = [tuple(r) for r in df.collect()], rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(rel.columns, d_rows)[0]


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["source_system", "close_date__fiscal_quarter"]
    assert df.count() > 0
