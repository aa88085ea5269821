"""The training-data queries that have SQL, against DuckDB over the same tables."""

from __future__ import annotations

import duckdb
import pytest
from conftest import MEDIUM

from creditmart.llm import oracle, queries


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{MEDIUM}/documents.parquet'")
    found, expected = queries.queries()[name](spark, MEDIUM), con.sql(oracle.oracle_sql()[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    got = sorted(map(tuple, found.select(*columns).collect()))
    assert got == sorted(expected.select(*(f'"{c}"' for c in columns)).fetchall())


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.queries()) == list(range(1, 14))
