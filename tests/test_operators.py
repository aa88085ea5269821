"""Operators on hand-made rows: edges, skew, exactness, independence of partitioning."""

from __future__ import annotations

import math
import random
import struct
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from pyspark.sql import functions as F
from creditmart import rules
from creditmart.functions import scalars as sc
from creditmart.operators import clean, evaluate, features, marts, profile, quantiles, sampling, summaries
from creditmart.plans import catalog

DETAIL = "app_id bigint, loan_amnt double, purpose string, addr_state string, emp_length double, dti double, zip_code string, label int"


def detail_rows(spark, n=400, hot_share=1 / 3, seed=1):
    """Detail rows in which one state and one zip hold a third of everything."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        hot = rng.random() < hot_share
        data.append(
            (
                i,
                float(rng.randrange(100, 5000)) / 10,
                rng.choice(["car", "house", "other"]),
                "CA" if hot else rng.choice(rules.VALID_STATES),
                float(rng.randrange(11)),
                None if rng.random() < 0.1 else float(rng.randrange(201)),
                "945" if hot else f"{rng.randrange(1000):03d}",
                int(rng.random() < 0.3),
            )
        )
    return spark.createDataFrame(data, DETAIL)


# --- summaries and marts ------------------------------------------------------------


def test_counts_conserve_and_rates_are_shares(spark, sf_dir):
    detail = catalog.detail(spark, sf_dir)
    geo = summaries.geo_stats(detail).collect()
    assert sum(r.total_cnt for r in geo) == detail.count()
    assert all(r.approved_cnt + r.rejected_cnt == r.total_cnt for r in geo)
    assert all(0 <= r.approval_rate <= 1 for r in geo)


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_results_do_not_depend_on_partitioning(spark, parts):
    detail = detail_rows(spark)
    spread = detail.repartition(parts, "app_id")
    for summarise in (summaries.geo_stats, summaries.purpose_stats, summaries.zip_stats):
        assert rows(summarise(spread)) == rows(summarise(detail.coalesce(1)))
    balanced = sampling.undersample_exact(spread, "app_id", ratio=1)
    assert rows(balanced) == rows(sampling.undersample_exact(detail.coalesce(1), "app_id", ratio=1))


def test_summaries_of_nothing(spark):
    empty = detail_rows(spark, n=1).limit(0)
    assert summaries.geo_stats(empty).count() == 0
    row = summaries.kpi_metrics(empty).first()
    assert (row.total_cnt, row.approval_rate, row.avg_dti) == (0, None, None)
    assert profile.missing_rates(empty, ["dti"]).first().asDict() == {
        "column_name": "dti", "n_rows": 0, "n_missing": 0, "missing_pct": None, "is_high": False,
    }


REPORT = "year int, month int, year_month string, loan_amnt double, dti double, addr_state string, label int"


def test_trend_fills_counts_only(spark):
    rej = spark.createDataFrame([(2015, 1, "2015-01", 10.0, 1.0, "CA", 0)], REPORT)
    acc = spark.createDataFrame([(2015, 2, "2015-02", 20.0, 1.0, "NY", 1)], REPORT).selectExpr(
        "*", "7.5D AS int_rate", "1000D AS annual_inc"
    )
    got = {r.month: r for r in marts.trend_monthly(rej, acc).collect()}
    assert (got[1].acc_cnt, got[1].avg_int_rate, got[1].avg_loan_amnt_acc, got[1].approval_rate) == (0, None, None, 0.0)
    assert (got[2].rej_cnt, got[2].avg_loan_amnt_rej, got[2].approval_rate) == (0, None, 1.0)
    states = {r.state_code: r for r in marts.geo_map(rej, acc).collect()}
    assert (states["CA"].avg_int_rate, states["CA"].state_name) == (0.0, "California")
    exact = {r.state_code: r for r in marts.geo_map_exact(rej, acc).collect()}
    assert exact["CA"].avg_int_rate is None and exact["NY"].avg_loan_amnt == 20.0


def test_undated_rejections_count_on_the_map_only(spark):
    raw = spark.createDataFrame(
        [("100.0", "bad", "car", "600", "5%", "945xx", "CA", "1 year", "0")],
        "loan_amnt_raw string, application_date string, loan_title string, risk_score string, dti_raw string, "
        "zip_code string, state string, employment_length string, policy_code string",
    )
    assert clean.report_rejected(raw).count() == 0
    assert clean.report_rejected(raw, require_date=False).count() == 1


def test_accepted_purpose_is_normalized_on_request(spark, sf_dir):
    raw = catalog.accepted_feed(spark, sf_dir)
    as_given = {r.purpose for r in clean.report_accepted(raw).select("purpose").distinct().collect()}
    classes = {r.purpose for r in clean.report_accepted(raw, normalize=True).select("purpose").distinct().collect()}
    allowed = {p for p, _ in rules.PURPOSE_RULES} | {rules.PURPOSE_OTHER}
    assert classes <= allowed and "Debt Consolidation" in as_given


def test_rollup_levels(spark, sf_dir):
    got = catalog.queries()["reject_time_rollup"](spark, sf_dir).collect()
    total = next(r.rej_cnt for r in got if r.level == 7)
    for level in (0, 1, 3):
        assert sum(r.rej_cnt for r in got if r.level == level) == total


def test_dedupe_keeps_first_and_counts_a_hot_key(spark):
    data = [("hot", i, f"v{i}") for i in range(300)] + [(f"k{i}", i, "x") for i in range(50)]
    df = spark.createDataFrame(data, "k string, ord int, v string").repartition(5)
    got = {r.k: r for r in clean.dedupe(df, ["k"], ["ord"]).collect()}
    assert len(got) == 51
    assert (got["hot"].ord, got["hot"].v, got["hot"].n_copies) == (0, "v0", 300)


# --- quantiles ---------------------------------------------------------------------------


def brute_disc(values, p):
    ordered = sorted(values)
    return ordered[max(math.ceil(p * len(ordered)), 1) - 1]


def brute_cont(values, p):
    ordered = sorted(values)
    spot = p * (len(ordered) - 1)
    low, high = ordered[math.floor(spot)], ordered[math.ceil(spot)]
    return low + (high - low) * (spot - math.floor(spot))


SHARES = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.one_of(st.sampled_from([0.0, 7.5]), st.floats(-1e9, 1e9), st.floats(0, 1e-9)), min_size=1, max_size=60
    )
)
def test_quantiles_equal_brute_force(spark, values):
    df = spark.createDataFrame([("a", v) for v in values] + [("b", None), ("c", 3.0)], "g string, v double")
    disc = {r.g: r for r in quantiles.exact_quantiles(df, ["g"], "v", SHARES).collect()}
    cont = {r.g: r for r in quantiles.exact_quantiles(df, ["g"], "v", SHARES, interpolate=True).collect()}
    assert set(disc) == {"a", "c"}
    for name, p in SHARES.items():
        assert disc["a"][name] == brute_disc(values, p)
        assert cont["a"][name] == pytest.approx(brute_cont(values, p), rel=1e-12, abs=1e-12)
        assert disc["c"][name] == 3.0


def test_quantiles_with_outliers_infinities_and_a_hot_value(spark):
    rng = random.Random(3)
    values = [42.0] * 500 + [rng.random() for _ in range(700)] + [1e18, -1e18, float("inf"), float("-inf")]
    df = spark.createDataFrame([("a", v) for v in values], "g string, v double").repartition(7)
    got = quantiles.exact_quantiles(df, ["g"], "v", {"a": 0.1, "b": 0.5, "c": 0.8}).first()
    assert [got.a, got.b, got.c] == [brute_disc(values, p) for p in (0.1, 0.5, 0.8)]


def test_keys_of_doubles_are_their_bits(spark):
    rng = random.Random(5)
    values = [0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, math.nextafter(1.0, 0), math.nextafter(2.0, 3), 1.7976931348623157e308, float("inf")]
    values += [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(63)))[0] for _ in range(3000)] + [2.0**e for e in range(-1074, 1024, 7)]
    values += [math.nextafter(2.0**e, 0) for e in range(-1000, 1024, 5)]
    df = spark.createDataFrame([(v,) for v in values if v == v] + [(-v,) for v in values if v == v and v], "v double")
    bits = lambda v: struct.unpack("<q", struct.pack("<d", abs(v)))[0] * (-1 if v < 0 else 1)
    assert all(r["_k"] == bits(r["_v"]) for r in quantiles.keyed(df, [], "v").collect())
    nan, inf = (quantiles.keyed(spark.sql(f"SELECT CAST('{v}' AS double) AS v"), [], "v").first()["_k"] for v in ("NaN", "Infinity"))
    assert nan > inf


def test_distinct_values_that_agree_in_their_leading_bits(spark):
    """Two million distinct values in one narrow cell: passes go on until few are left to be ranked."""
    df = spark.range(2_000_000).selectExpr("'a' AS g", "1 + id * power(2.0D, -52) AS v")
    base = quantiles.keyed(df, ["g"], "v")
    cells, shift = quantiles.refined(base, ["g"], [0.5], False)
    assert shift <= 15 and cells.agg(F.max("_c")).first()[0] <= quantiles.CELL_ROWS
    assert quantiles.exact_quantiles(df, ["g"], "v", {"p": 0.5}).first().p == 1 + 999_999 * 2.0**-52


def test_copies_of_one_value_need_no_more_passes(spark):
    df = spark.range(200_000).selectExpr("'a' AS g", "IF(id < 150000, 3.0D, id * 1.0D) AS v")
    assert quantiles.refined(quantiles.keyed(df, ["g"], "v"), ["g"], [0.5], False)[1] == quantiles.SHIFTS[0]


# --- sampling -------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [1, 40])
def test_exact_sample_where_leading_digits_tie(spark, monkeypatch, limit):
    """Rows whose first 24 bits, or whole key digests, agree: the boundary is refined by all that tells them apart."""
    monkeypatch.setattr(sampling, "BOUNDARY_ROWS", limit)
    monkeypatch.setattr(sampling.sc, "keyed_hash", lambda salt, key: f"concat('abcdef', substring(md5(CAST({key} % 50 AS string)), 1, 26))")
    df = spark.range(300).selectExpr("id AS k", "id % 7 AS v", "0 AS g").unionByName(spark.range(60).selectExpr("3L AS k", "5L AS v", "0 AS g"))
    quotas = spark.createDataFrame([(0, 117)], "g int, quota int")
    marked = sampling.mark_exactly(df, quotas, "g", "k", "s")
    found = sorted(tuple(r) for r in marked.collect())
    assert sum(r[-1] for r in found) == 117 and sorted(r[:-1] for r in found) == sorted(tuple(r) for r in df.collect())
    again = sampling.mark_exactly(df.repartition(5), quotas, "g", "k", "s")
    assert sorted(tuple(r) for r in again.collect()) == found


@pytest.mark.parametrize("ratio", [1, 2, 100])
def test_exact_undersample_size(spark, ratio):
    detail = detail_rows(spark)
    n = Counter(r.label for r in detail.collect())
    got = sampling.undersample_exact(detail, "app_id", ratio).collect()
    kept = Counter(r.label for r in got)
    assert kept == {0: min(ratio * n[1], n[0]), 1: n[1]}
    assert len({r.app_id for r in got}) == len(got)


def test_exact_sample_of_identical_copies(spark, monkeypatch):
    """A pile of copies at the boundary is split by count, whatever the size of a run."""
    monkeypatch.setattr(sampling, "_COPY_RUN", 7)
    df = spark.createDataFrame([(1, 0)] * 90 + [(2, 0)] * 10 + [(3, 1)] * 5, "app_id int, label int").repartition(6)
    marked = sampling.mark_exactly(
        df, spark.createDataFrame([(0, 55), (1, 0)], "label int, quota int"), "label", "app_id", "s"
    ).collect()
    assert Counter(r.app_id for r in marked) == {1: 90, 2: 10, 3: 5}
    assert Counter(r.label for r in marked if r.picked) == {0: 55}


def test_splits_are_disjoint_and_complete(spark):
    detail = detail_rows(spark)
    for split in (sampling.split_hash(detail, "app_id"), sampling.split_stratified(detail, "app_id")):
        got = split.collect()
        assert sorted(r.app_id for r in got) == list(range(400))
        assert {r.split for r in got} == {"train", "test"}
    n = Counter(r.label for r in got)
    train = Counter(r.label for r in got if r.split == "train")
    assert sum(train.values()) == 400 - math.ceil(0.2 * 400)
    assert all(abs(train[k] - 0.8 * n[k]) <= 1 for k in n)


def test_sample_scan_gives_n_rows_or_all(spark):
    detail = detail_rows(spark, n=50)
    assert sampling.sample_scan(detail, "app_id", 20).count() == 20
    assert sampling.sample_scan(detail, "app_id", 500).count() == 50


def test_undersample_and_split_use_independent_hashes(spark, sf_dir):
    kept = sampling.undersample_hash(catalog.detail(spark, sf_dir), "app_id", ratio=0.5).where("label = 0")
    shares = Counter(r.split for r in sampling.split_hash(kept, "app_id").collect())
    assert 0.7 < shares["train"] / sum(shares.values()) < 0.9


# --- profiling --------------------------------------------------------------------------------


def test_top_values_ranks_within_field_and_limits_before_the_shuffle(spark):
    data = [("f", f"v{i % 30}") for i in range(900)] + [("f", "hot")] * 500 + [("g", None)] * 3
    values = spark.createDataFrame(data, "field string, value string").repartition(5)
    top = profile.top_values(values, 3)
    assert rows(top) == [("f", "hot", 500, 1), ("f", "v0", 30, 2), ("f", "v1", 30, 3), ("g", None, 3, 1)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_schema_report(spark):
    got = profile.schema_report(spark.createDataFrame([], "a int, b string")).collect()
    assert [(r.position, r.column_name, r.data_type) for r in got] == [(1, "a", "int"), (2, "b", "string")]


def test_missing_rate_counts_null_and_empty(spark):
    df = spark.createDataFrame([("x", 1.0), ("", None), (None, 2.0), ("y", 3.0)], "t string, n double")
    got = {r.column_name: (r.n_missing, r.missing_pct, r.is_high) for r in profile.missing_rates(df, ["t", "n"]).collect()}
    assert got == {"t": (2, 50.0, True), "n": (1, 25.0, True)}
    bands = {r.column_name: r.band for r in profile.missing_bands(df, ["t", "n"]).collect()}
    assert bands == {"t": "5-50%", "n": "5-50%"}


def test_iqr_on_empty_and_constant_fields(spark):
    df = spark.createDataFrame([("a", 5.0)] * 10 + [("b", None)], "field string, value double")
    got = profile.iqr_outliers(df, ["field"]).collect()
    assert [(r.field, r.q1, r.q3, r.n_outliers, r.pct_outliers) for r in got] == [("a", 5.0, 5.0, 0, 0.0)]


# --- features -----------------------------------------------------------------------------------


def test_unseen_and_null_keys_take_defaults(spark):
    history = detail_rows(spark)
    new = spark.createDataFrame([(1, None, "nothing", None, None, None, "zzz", 1)], DETAIL)
    row = features.attach_rates(new, history).first()
    for name, default in rules.FEATURE_DEFAULTS.items():
        assert row[name] == default


def test_attach_rates_keeps_every_row_with_a_hot_key(spark):
    detail = detail_rows(spark)
    got = features.model_input(detail, carry=["app_id"]).collect()
    assert sorted(r.app_id for r in got) == list(range(400))
    by_state = {r.addr_state: r.approval_rate for r in summaries.geo_stats(detail).collect()}
    assert all(r.state_approval_rate == by_state[r.addr_state] for r in got)


def test_out_of_fold_rate_ignores_own_fold(spark):
    detail = detail_rows(spark)
    got = features.out_of_fold_rates(detail, "app_id").collect()
    assert len(got) == 400
    for r in got[:40]:
        others = [x.label for x in got if x.addr_state == r.addr_state and x.fold != r.fold]
        want = sum(others) / len(others) if others else rules.FEATURE_DEFAULTS["state_approval_rate"]
        assert r.oof_state_approval_rate == pytest.approx(want, abs=5.1e-5)


def test_leakage_guard(spark):
    features.check_no_leakage(["loan_amnt", "dti"])
    with pytest.raises(ValueError, match="grade, int_rate"):
        features.check_no_leakage(["int_rate", "loan_amnt", "grade"])
    assert len(rules.PRE_APPROVAL_COLUMNS) == 23 and len(rules.POST_APPROVAL_COLUMNS) == 14
    df = spark.createDataFrame([], "loan_amnt double, int_rate double, dti double")
    assert features.pre_approval(df).columns == ["loan_amnt", "dti"]


# --- evaluation -----------------------------------------------------------------------------------


def scored(spark, n=300, seed=5, hot=True):
    rng = random.Random(seed)
    data = [
        (int(rng.random() < 0.4), 0.25 if hot and rng.random() < 0.34 else rng.random() * (1.3 if hot else 1) - 0.1)
        for _ in range(n)
    ]
    return data, spark.createDataFrame(data, "label int, prob_1 double").repartition(5)


def test_auc_equals_pair_count_with_ties_and_scores_outside_the_unit_range(spark):
    data, df = scored(spark)
    pos = [p for y, p in data if y == 1]
    neg = [p for y, p in data if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    got = evaluate.auc_rank(df).first()
    assert (got.n_pos, got.n_neg) == (len(pos), len(neg))
    assert got.auc_roc == pytest.approx(wins / len(pos) / len(neg), abs=1e-6)


def test_auc_pr_equals_trapezoids(spark):
    data, df = scored(spark)
    points, tp, fp = [], 0, 0
    for t in sorted({p for _, p in data}, reverse=True):
        tp += sum(1 for y, p in data if p == t and y == 1)
        fp += sum(1 for y, p in data if p == t and y == 0)
        points.append((tp / sum(y for y, _ in data), tp / (tp + fp)))
    area, before = 0.0, (0.0, points[0][1])
    for recall, precision in points:
        area += (recall - before[0]) * (precision + before[1]) / 2
        before = (recall, precision)
    assert evaluate.auc_rank(df).first().auc_pr == pytest.approx(area, abs=1e-6)


def test_metrics_are_zero_when_undefined_and_null_without_rows(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.2)], "label int, prob_1 double")
    got = evaluate.classification_metrics(evaluate.with_prediction(df)).first()
    assert (got.precision_1, got.recall_1, got.f1_1, got.accuracy) == (0.0, 0.0, 0.0, 0.5)
    assert evaluate.classification_metrics(evaluate.with_prediction(df.limit(0))).first().accuracy is None
    sweep = {r.threshold: (r.tp, r.fp, r.fn) for r in evaluate.threshold_sweep(df, (0.15, 0.9)).collect()}
    assert sweep == {0.15: (1, 0, 0), 0.9: (0, 0, 1)}


def test_bad_hash_slices_never_appear(spark):
    df = spark.range(1000).selectExpr(f"{sc.hash_slice(sc.keyed_hash('s', 'id'), 1, 3)} AS h")
    low, high = df.selectExpr("min(h)", "max(h)").first()
    assert 0 <= low < high < 4096


def test_scores_of_any_scale_spread_over_cells(spark):
    tiny = spark.range(50_000).selectExpr("1e-16D * (1 + id) AS prob_1", "CAST(id % 3 = 0 AS int) AS label")
    sure = spark.range(50_000).selectExpr("1 - 1e-13D * (1 + id) AS prob_1", "0 AS label")
    margins = spark.range(50_000).selectExpr("(id - 25000) * 1.5D AS prob_1", "1 AS label")
    for scores in (tiny, sure, margins):
        cells = scores.distinct().groupBy(F.expr(evaluate._SCORE_CELL)).count().agg(F.max("count")).first()[0]
        assert cells <= 64
    placed = tiny.unionByName(sure).unionByName(margins).selectExpr("prob_1", f"{evaluate._SCORE_CELL} AS cell").orderBy("prob_1").collect()
    assert all(a.cell <= b.cell for a, b in zip(placed, placed[1:], strict=False))
