"""Heavy values, drop accounting, quarantined lines, and boosting that ends with its area."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import rows
from creditmart.operators import clean, evaluate, heavy, models, profile, sampling
from creditmart.plans import catalog, warehouse
from creditmart.sources import files
from creditmart.sources.feeds import rejected_feed


def top(values: list, k: int) -> list[tuple]:
    counted = sorted(Counter(values).items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))
    return counted[:k]


@pytest.mark.parametrize("kind", ["skewed", "flat", "few", "none"])
def test_most_frequent_values_are_exact(spark, monkeypatch, kind):
    monkeypatch.setattr(heavy, "_SLOTS", tuple(f"pmod(xxhash64({i}, _value IS NULL, _value), 64)" for i in (1, 2)))  # many values share a bucket
    pick = random.Random(2)
    values = {
        "skewed": [f"v{int(pick.paretovariate(0.6)) % 5000}" for _ in range(6000)] + [None] * 900 + [""] * 700,
        "flat": [f"v{i}" for i in range(3000)],
        "few": ["a", "b", None, "a"],
        "none": [],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values], "x string").repartition(5)
    found = [(r["x"], r["cnt"], r["total"]) for r in heavy.top_k_values(df, "x", 10).collect()]
    assert sorted(found, key=repr) == sorted(((v, n, len(values)) for v, n in top(values, 10)), key=repr)


def test_rare_values_are_not_counted_one_by_one(spark):
    df = spark.range(300_000).selectExpr("IF(id % 3 = 0, concat('hot', id % 20), CAST(id AS string)) AS x")
    kept, _ = heavy.survivors(df, "x", 10)
    assert kept.groupBy("_value").count().count() < 2_000  # of 200,020 distinct values
    assert profile.pct_of_total(df, "x", 10).select("cnt").distinct().count() == 1


def test_reasons_add_up(spark, sf_dir, tmp_path):
    raw = rejected_feed(spark, sf_dir)
    odd = raw.withColumn("state", F.expr("IF(app_id % 9 = 0, NULL, state)")).withColumn("loan_amnt_raw", F.expr("IF(app_id % 11 = 0, 'many', loan_amnt_raw)"))
    counts = warehouse.build_counted_detail(odd, False, str(tmp_path / "d"), ("app_id",))
    dropped = {name: n for name, n in counts.items() if name.startswith("dropped_")}
    assert counts["rows"] == raw.count() == counts["kept"] + sum(dropped.values()) and all(dropped.values())
    kept = files.read_layer(spark, str(tmp_path / "d"))
    expected = clean.clean_rejected(odd, carry=["app_id"])
    assert kept.columns == expected.columns and rows(kept) == rows(expected) and kept.count() == counts["kept"]
    by_set = clean.drop_reasons(odd, False).collect()
    assert sum(r["cnt"] for r in by_set) == counts["rows"] and {r["failed_rules"]: r["cnt"] for r in by_set}[0] == counts["kept"]
    assert sum(r["cnt"] for r in by_set if "amount" in r["reasons"]) == odd.where("loan_amnt_raw = 'many'").count()


LINES = ['1,"a, b",x', "2,plain,y", '3,"open,z', "4,too,many,fields", "5,few", '6,"said ""hi""",z', "", '7,,""', '8,"ok",end']


def test_lines_that_do_not_parse_are_set_aside(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,b,c\n" + "\n".join(LINES) + "\n")
    good, bad, counts = files.read_with_quarantine(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), ("id", "b", "c"))
    assert {r["id"] for r in good.collect()} >= {"1", "2", "7", "8"}
    found = {r["line"]: r["reason"] for r in bad.collect()}
    assert found['3,"open,z'] == "open quote" and found["4,too,many,fields"] == "too many fields" and found["5,few"] == "too few fields"
    assert all(r["file"].endswith("in.csv") for r in bad.collect())
    assert counts["lines"] == counts["rows"] + counts["quarantined"] == good.count() + bad.count() and good.columns == ["id", "b", "c"]


def test_stopping_rule():
    assert models.stopping_round([0.5, 0.6, 0.7], 2) == (3, False)
    assert models.stopping_round([0.5, 0.7, 0.6, 0.7], 2) == (2, True)
    assert models.stopping_round([0.7, 0.6, 0.8, 0.6, 0.6, 0.9], 2) == (3, True)
    assert models.stopping_round([0.5], 1) == (1, False)


def test_boosting_ends_with_its_area_and_keeps_its_best_round(spark, sf_dir, tmp_path):
    noisy = catalog.detail(spark, sf_dir).withColumn("label", F.expr("CAST(app_id % 7 < 3 AS int)"))  # nothing to learn
    flagged = sampling.validation_flag(noisy, "app_id", 0.4)
    run = models.boost_with_patience(flagged, models.one_hot_features(models.RAW_ONLY), rounds=40, patience=3, maxDepth=2)
    assert run.stopped and run.best_round <= run.rounds - 3 and run.areas[run.best_round - 1] == max(run.areas[: run.best_round + 3])
    assert run.fitted.classifier.getNumTrees == run.best_round
    check = flagged.where("is_validation")
    again = models.load_model(models.save_model(run.fitted, str(tmp_path)))
    assert again.classifier.getNumTrees == run.best_round
    assert evaluate.auc_rank(again.score(check)).first()["auc_roc"] == run.areas[run.best_round - 1]


def test_areas_by_group_equal_areas_of_each(spark):
    pick = random.Random(3)
    df = spark.createDataFrame([(k % 3, pick.randint(0, 1), round(pick.uniform(-3, 3), 1)) for k in range(900)], "g int, label int, prob_1 double")
    by = {r["g"]: r["auc_roc"] for r in evaluate.auc_rank(df, ["g"]).collect()}
    assert by == {g: evaluate.auc_rank(df.where(f"g = {g}")).first()["auc_roc"] for g in range(3)}
