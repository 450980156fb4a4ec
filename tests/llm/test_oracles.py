"""Queries of the llm subpackage that SQL can express, against DuckDB."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

from compare import TABLES, digest  # noqa: E402

from dimstar.llm.queries import ORACLE, REGISTRY  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df, rel = REGISTRY[name](spark, SMALL), con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0]


def test_one_query_for_each_operator():
    assert [sum(n.startswith(f"op{k}_") for n in REGISTRY) for k in range(1, 11)] == [1] * 10
