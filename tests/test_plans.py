"""Physical plans: what is read, what is shuffled, what stays in the JVM."""

from __future__ import annotations

import re
import subprocess
import sys

import pytest

from conftest import ROOT
from creditmart.operators import sampling, summaries
from creditmart.plans import catalog

ITERATIVE = {"model_leaderboard", "tree_importance"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_importing_the_contract_needs_no_session():
    code = "import __spark_entry__ as e; assert len(e.queries()) >= len(e.oracle_sql()) > 60"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - ITERATIVE))
def test_no_python_and_no_cartesian_product(spark, sf_dir, name):
    text = plan(catalog.queries()[name](spark, sf_dir))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_scan_is_pruned_and_filtered(spark, sf_dir):
    text = plan(summaries.geo_stats(catalog.detail_rejected(spark, sf_dir)))
    orders = next(line for line in text.splitlines() if "FileScan" in line and "o_orderkey" in line)
    read = set(re.search(r"parquet \[([^\]]*)\]", orders).group(1).replace("L", "").split(","))
    assert {re.sub(r"#\d+", "", c) for c in read} == {"o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"}
    formatted = summaries.geo_stats(catalog.detail_rejected(spark, sf_dir))._jdf.queryExecution()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    assert "Not(EqualTo(o_orderstatus,F))" in formatted.explainString(mode)


def test_purpose_text_is_lowered_once_per_row(spark, sf_dir):
    text = plan(catalog.queries()["purpose_normalize"](spark, sf_dir))
    assert text.count("lower(trim(") == 1
    assert text.count("Contains(_purpose_key") >= 10


def test_summary_is_one_shuffle_with_partial_aggregation(spark, sf_dir):
    detail = catalog.staged_detail(spark, sf_dir)
    text = plan(summaries.zip_stats(detail))
    assert text.count("Exchange") == 1 and "partial_avg" in text


def test_rate_joins_shuffle_no_detail_rows(spark, sf_dir):
    text = plan(catalog.queries()["ads_features"](spark, sf_dir))
    assert text.count("BroadcastHashJoin") == 3
    assert "SortMergeJoin" not in text


def test_large_rate_table_is_not_broadcast(spark, sf_dir):
    """Past the size limit the zip lookup is shuffled, while the bounded tables are not."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = plan(catalog.queries()["ads_features"](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("BroadcastHashJoin") == 2 and text.count("SortMergeJoin") == 1


def test_exact_sampling_ranks_boundary_rows_only(spark, sf_dir):
    detail = catalog.staged_detail(spark, sf_dir)
    text = plan(sampling.undersample_exact(detail, "app_id", 1))
    # The large branch is a broadcast join over the scan: no exchange above it.
    large = text.split("Union")[1].splitlines()[1:4]
    assert any("Project" in line for line in large) and not any("Exchange" in line for line in large)


@pytest.mark.parametrize("name", ["dws_geo", "trend_monthly", "ads_features", "undersample_exact_even", "auc_rank"])
def test_same_results_when_nothing_is_broadcast_by_size(spark, sf_dir, name):
    query = catalog.queries()[name]

    def result():
        df = query(spark, sf_dir)
        return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)

    expected = result()
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    try:
        assert result() == expected
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
