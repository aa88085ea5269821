"""Every query with a SQL form against DuckDB over the same tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import MEDIUM, SMALL
from creditmart.plans import catalog
from oracle import statements

TABLES = ("orders", "customer", "documents")
ORACLES = statements.oracle_sql()
QUERIES = catalog.queries()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, 0 if v is None else v) for v in r))


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(ORACLES) <= set(contract.oracle_sql()) and set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) - set(ORACLES) == {"model_leaderboard", "tree_importance"}


def test_flagship_query(spark):
    flagship = contract.entry(spark)
    assert flagship.columns[0] == "addr_state" and 0 < flagship.count() <= 51


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    expected = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types), strict=True))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    got = [tuple(r) for r in df.select(*columns).collect()]
    want = expected.select(*(f'"{c}"' for c in columns)).fetchall()
    assert _sorted(got) == _sorted(want)


def test_golden_counts(spark):
    """Row counts fixed by the data model at the middle scale."""
    q = QUERIES
    assert q["dwd_rejected_clean"](spark, MEDIUM).count() == 7184
    assert q["dwd_accepted_clean"](spark, MEDIUM).count() == 4023
    kpi = q["kpi_metrics"](spark, MEDIUM).first()
    assert (kpi.n_states, kpi.n_zips) == (51, 982)
    assert q["dws_purpose"](spark, MEDIUM).count() == 14
    assert q["dws_emp"](spark, MEDIUM).count() == 11
    assert q["split_hash"](spark, MEDIUM).count() == 11207
