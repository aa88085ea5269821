"""Exact sums, mergeable states, versioned tables and incremental refresh."""

from __future__ import annotations

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from creditmart.functions import exprs
from creditmart.operators import clean, exact, rollups, states, summaries
from creditmart.plans import catalog, refresh, warehouse
from creditmart.sources import publish, versions
from creditmart.sources.feeds import accepted_feed, feeds, rejected_feed


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def state_of(df, **measures):
    return df.groupBy("g").agg(*exprs(exact.parts(measures))).selectExpr("g", *exact.joined(list(measures)))


def test_sums_are_exact_in_any_order(spark):
    pick = random.Random(1)
    values = [round(pick.uniform(-1e5, 1e5), pick.choice([0, 2, 9])) for _ in range(3000)] + [1e15, -1e15, 0.1, 0.2, 1e-9, -1e-9]
    df = spark.createDataFrame([(k % 3, v) for k, v in enumerate(values)] + [(0, None), (9, None)], "g int, x double")
    found = {r["g"]: r for r in state_of(df.repartition(7), x="x").collect()}
    again = {r["g"]: r for r in state_of(df.orderBy(F.rand(3)).repartition(3), x="x").collect()}
    assert found == again
    for g in range(3):
        assert found[g]["x_sum"] == sum(Decimal(str(v)) for v in values[g::3]) and found[g]["x_n"] == len(values[g::3])
    assert (found[9]["x_n"], found[9]["x_sum"], found[9]["x_far"]) == (0, None, None)


def test_values_without_end_are_summed_apart(spark):
    df = spark.createDataFrame([("a", 1e300), ("a", 2.5), ("b", float("inf")), ("c", float("nan")), ("d", -3e200), ("d", -3e200)], "g string, x double")
    found = {r["g"]: r["m"] for r in state_of(df, x="x").groupBy("g").agg(F.expr(f"{exact.mean('x', 2)} AS m")).collect()}
    assert found["a"] == 5e299 and found["b"] == math.inf and math.isnan(found["c"]) and found["d"] == -3e200


def test_means_and_deviations(spark):
    df = spark.createDataFrame([("a", 1.005), ("a", 1.005), ("b", 10.0), ("c", None), ("d", 1.0), ("d", 2.0), ("d", 4.0)], "g string, x double")
    merged = state_of(df, x="x", xx="x * x").groupBy("g").agg(*exprs([f"{exact.mean('x', 2)} AS m", f"{exact.deviation('x', 'xx', 4)} AS s"]))
    assert rows(merged, "g", "m", "s") == [("a", 1.01, 0.0), ("b", 10.0, None), ("c", None, None), ("d", 2.33, 1.5275)]


def test_merging_parts_gives_the_whole(spark, sf_dir):
    accepted = clean.report_accepted(accepted_feed(spark, sf_dir))
    whole = states.accepted_states(accepted)
    halves = states.accepted_states(accepted.where("loan_amnt < 15000")).unionByName(states.accepted_states(accepted.where("loan_amnt >= 15000")))
    merged = states.merge(halves, states.ACCEPTED_MEASURES, ("charged_off",))
    assert rows(merged, *sorted(whole.columns)) == rows(whole, *sorted(whole.columns))


def test_states_take_one_scan_and_one_shuffle(spark, sf_dir):
    accepted = clean.report_accepted(accepted_feed(spark, sf_dir))
    text = plan(states.accepted_states(accepted))
    assert sum("FileScan" in line and "o_orderkey" in line for line in text.splitlines()) == 1
    assert text.count("Exchange hashpartitioning") == 1 and "Expand" in text
    held = warehouse.feed_states(*feeds(spark, sf_dir))
    for build in warehouse.ROLLUPS.values():
        assert "o_orderkey" not in plan(build(*held))


def test_rollups_are_bit_identical_under_any_partitioning(spark, sf_dir):
    detail = catalog.staged_detail(spark, sf_dir)

    def result(df):
        found = rollups.geo_stats(states.detail_states(df))
        return rows(found, *sorted(found.columns))

    expected = result(detail)
    assert all(result(detail.orderBy(F.rand(seed)).repartition(seed)) == expected for seed in (2, 7))
    direct = summaries.geo_stats(detail)
    assert rows(direct, *sorted(direct.columns)) == expected


# --- versions ---------------------------------------------------------------------------------


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    path, good = str(tmp_path / "t"), spark.range(10).withColumn("p", F.col("id") % 2)
    versions.replace(good, path)
    bad = good.repartition(5).withColumn("id", F.expr("IF(id = 7, CAST(raise_error('halfway') AS bigint), id)"))
    with pytest.raises(Exception, match="halfway"):
        versions.replace(bad, path)
    assert versions.read(spark, path, good.schema).count() == 10
    assert len(list((tmp_path / "t").glob("version=*"))) == 2  # what the failed write left is in a folder of its own
    assert versions.vacuum(spark, path) == 1 and versions.read(spark, path, good.schema).count() == 10


def test_published_tables_survive_a_failed_publish(spark, sf_dir, tmp_path):
    geo = summaries.geo_stats(catalog.detail(spark, sf_dir))
    publish.publish_parquet(geo, "geo_lookup", str(tmp_path))
    long = geo.withColumn("addr_state", F.expr("IF(addr_state = 'TX', 'too long a name', addr_state)"))
    with pytest.raises(Exception, match="longer than"):
        publish.publish_parquet(long, "geo_lookup", str(tmp_path))
    assert publish.read_published(spark, "geo_lookup", str(tmp_path)).count() == geo.count()


def test_parts_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "2001-01"), (2, "2001-02"), (3, None)], "id int, m string")
    first = versions.replace(df, path, "m")
    assert set(first) == {"2001-01", "2001-02", versions.NO_VALUE}
    second = versions.replace(spark.createDataFrame([(7, "2001-02"), (8, "2001-02")], df.schema), path, "m", ["2001-02", None])
    assert second["2001-01"] == first["2001-01"] and versions.NO_VALUE not in second
    assert rows(versions.read(spark, path, df.schema)) == [(1, "2001-01"), (7, "2001-02"), (8, "2001-02")]
    assert rows(versions.read(spark, path, df.schema, ["2001-01"])) == [(1, "2001-01")]
    with pytest.raises(ValueError):
        versions.replace(df, path, "m", ["2001-01"])
    assert versions.read(spark, str(tmp_path / "none"), df.schema).count() == 0


def test_vacuum_keeps_what_versions_name(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, m string")
    versions.replace(df, path, "m")
    for k in range(3):
        versions.replace(spark.createDataFrame([(k, "b")], df.schema), path, "m", ["b"])
    assert versions.vacuum(spark, path, keep=1) == 3  # three former parts b
    assert rows(versions.read(spark, path, df.schema)) == [(1, "a"), (2, "b")]


def test_the_second_of_two_writers_is_told(spark, tmp_path, monkeypatch):
    path, df = str(tmp_path / "t"), spark.range(3)
    versions.replace(df, path)
    numbers = versions._numbers
    calls = []

    def stale(session, folder):
        calls.append(folder)
        return [] if len(calls) == 1 else numbers(session, folder)

    monkeypatch.setattr(versions, "_numbers", stale)
    with pytest.raises(versions.Conflict):
        versions.replace(spark.range(99), path)
    assert versions.read(spark, path, df.schema).count() == 3


# --- refresh ----------------------------------------------------------------------------------------


def marts_of(spark, sf_dir) -> dict[str, list]:
    inputs = catalog.report_inputs(spark, sf_dir)
    return {name: rows(mart.build(inputs).select(*sorted(mart.build(inputs).columns))) for name, mart in warehouse.reporting_marts().items()}


def test_refreshing_months_equals_a_full_build(spark, sf_dir, tmp_path):
    rejected, accepted = feeds(spark, sf_dir)
    folder, months = str(tmp_path), ["1995-03", "1996-07", None]
    old = "coalesce(substring(application_date, 1, 7) NOT IN ('1995-03', '1996-07'), false)"
    refresh.load(rejected.where(old), accepted.where("issue_d <> 'Mar-1995' OR app_id % 2 = 0"), folder)
    before = {name: versions.parts(spark, f"{folder}/{name}") for name in ("rejected", "accepted", "rejected-states")}
    refresh.refresh(rejected, accepted, months, folder)
    after = {name: versions.parts(spark, f"{folder}/{name}") for name in before}
    for name in before:
        assert {m for m in after[name] if before[name].get(m) != after[name][m]} <= {"1995-03", "1996-07", versions.NO_VALUE}
    found = {name: rows(df.select(*sorted(df.columns))) for name, df in refresh.marts(rejected, accepted, folder).items()}
    assert found == marts_of(spark, sf_dir)


def test_a_month_that_lost_its_rows_goes(spark, sf_dir, tmp_path):
    rejected, accepted = feeds(spark, sf_dir)
    refresh.load(rejected, accepted, str(tmp_path))
    refresh.refresh(rejected.where("false"), accepted.where("false"), ["1995-03"], str(tmp_path))
    months = {r["year_month"] for r in refresh.marts(rejected, accepted, str(tmp_path))["trend_monthly"].collect()}
    assert "1995-03" not in months and "1995-04" in months


def test_a_refresh_reads_its_months_alone(spark, sf_dir, tmp_path):
    rejected = rejected_feed(spark, sf_dir)
    refresh.load(rejected, accepted_feed(spark, sf_dir), str(tmp_path))
    schema = clean.report_rejected(rejected, require_date=False).schema
    read = refresh.month_rows(spark, "rejected", str(tmp_path), schema, ["1995-03"])
    assert {f.split("year_month=")[1].split("/")[0] for f in read.inputFiles()} == {"1995-03"}
    assert 0 < states.of_cell(states.rejected_states(read), "state").agg(F.sum("n")).first()[0] < 100
