"""Model plumbing on a planted signal: structure and inequalities, never exact scores."""

from __future__ import annotations

import pytest

from creditmart.functions import scalars as sc
from creditmart.operators import features, models, sampling
from creditmart.plans import catalog, training
from creditmart.sources.stage import stage


@pytest.fixture(scope="module")
def planted(spark):
    """Feature rows whose label is ``dti < 20``, one in ten flipped by key."""
    rows = features.model_input(catalog.staged_detail(spark, "/root/testdata/sf0.001"), carry=["app_id"])
    flip = f"{sc.hash_slice(sc.keyed_hash('flip', 'app_id'), 1, 4)} % 10 = 0"
    label = f"CASE WHEN (dti < 20) <> ({flip}) THEN 1 ELSE 0 END AS label"
    return stage(rows.selectExpr(*(c for c in rows.columns if c != "label"), label), "planted")


SMALL = {
    "LogisticRegression": lambda: models.logistic_regression(maxIter=10),
    "RandomForest": lambda: models.random_forest(numTrees=5, maxDepth=3),
    "GBT": lambda: models.boosted_trees(maxIter=3, maxDepth=3),
}


@pytest.fixture(scope="module")
def run(planted, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("models"))
    classifiers = {name: make() for name, make in SMALL.items()}
    return folder, training.train_and_compare(planted, "app_id", classifiers=classifiers, save_to=folder)


def test_leaderboard_finds_the_signal(run):
    board = run[1].leaderboard.collect()
    assert {r.model for r in board} == set(SMALL)
    assert all(r.auc_roc > 0.6 and r.auc_pr > 0 for r in board)
    assert sum(r.is_best for r in board) == 1
    assert max(board, key=lambda r: r.auc_roc).is_best


def test_exact_areas_agree_with_the_binned_evaluator(run):
    board = {r.model: r for r in run[1].leaderboard.collect()}
    areas = models.evaluator_areas(run[1].fitted["GBT"].score(run[1].test))
    assert board["GBT"].auc_roc == pytest.approx(areas["areaUnderROC"], abs=1e-5)
    assert board["GBT"].auc_pr == pytest.approx(areas["areaUnderPR"], abs=1e-5)


def test_classifier_settings(spark):
    standard, raw = models.standard_classifiers(), models.raw_only_classifiers()
    assert (standard["RandomForest"].getNumTrees(), standard["RandomForest"].getMaxDepth()) == (50, 6)
    assert (standard["GBT"].getMaxIter(), standard["GBT"].getMaxBins(), standard["GBT"].getSubsamplingRate()) == (
        20, 16, 0.8,
    )
    assert (raw["RandomForest"].getNumTrees(), raw["RandomForest"].getMaxDepth(), raw["GBT"].getMaxIter()) == (
        100, 8, 50,
    )
    assert standard["LogisticRegression"].getRegParam() == raw["LogisticRegression"].getRegParam() == 0.01


def test_train_and_test_parts_are_disjoint(run):
    train, test = run[1].train, run[1].test
    assert train.join(test, "app_id", "left_semi").count() == 0
    assert train.count() > test.count() > 0


def test_saved_model_scores_the_same(run):
    folder, result = run
    for name, fitted in result.fitted.items():
        loaded = models.load_model(f"{folder}/{name}")
        a = {r.app_id: r.prob_1 for r in fitted.score(result.test).collect()}
        b = {r.app_id: r.prob_1 for r in loaded.score(result.test).collect()}
        assert a == b and all(0 <= p <= 1 for p in a.values())


def test_feature_slots_are_named_from_the_vector(planted, run):
    fitted = run[1].fitted["RandomForest"]
    train = run[1].train
    n_slots = sum(train.select(c).distinct().count() + 1 for c in models.WITH_RATES.categorical)
    assert len(fitted.feature_names) == n_slots + len(models.WITH_RATES.numeric)
    assert fitted.feature_names[-len(models.WITH_RATES.numeric):] == models.WITH_RATES.numeric
    assert sum("__unknown" in n for n in fitted.feature_names) == 2


def test_importances_rank_the_planted_column_first(spark, run):
    trees = models.tree_importance(spark, run[1].fitted["RandomForest"]).orderBy("rank").collect()
    assert trees[0].feature == "dti" and len(trees) == 15
    assert all(a.cumulative <= b.cumulative + 1e-12 for a, b in zip(trees, trees[1:], strict=False))
    linear = models.linear_importance(spark, run[1].fitted["LogisticRegression"]).collect()
    assert len(linear) == 10 and all(r.importance >= 0 for r in linear)


def test_scoring_unseen_categories(spark, run):
    row = run[1].test.limit(1).selectExpr(
        *(c for c in run[1].test.columns if c not in ("purpose", "addr_state")),
        "'never seen' AS purpose",
        "'ZZ' AS addr_state",
    )
    assert run[1].fitted["GBT"].score(row).count() == 1


def test_early_stopping_uses_the_validation_rows(planted):
    flagged = sampling.validation_flag(planted, "app_id")
    shares = {r.is_validation for r in flagged.select("is_validation").distinct().collect()}
    assert shares == {True, False}
    booster = models.boosted_trees_early_stop(maxIter=30, maxDepth=2, stepSize=0.5)
    fitted = models.fit_all(flagged, models.ordinal_features(models.RAW_ONLY), {"GBT": booster})["GBT"]
    assert 1 <= fitted.classifier.getNumTrees < 30
    assert fitted.feature_names[:3] == models.RAW_ONLY.numeric


def test_ordinal_codes_are_alphabetical(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("c", 3.0)], "purpose string, dti double")
    only = models.FeatureSet(categorical=("purpose",), numeric=("dti",))
    coded = models.ordinal_features(only).fit(df).transform(df)
    assert {r.purpose: r.purpose_code for r in coded.collect()} == {"a": 0.0, "b": 1.0, "c": 2.0}


def test_leaking_features_are_refused():
    with pytest.raises(ValueError, match="int_rate"):
        models.one_hot_features(models.FeatureSet(categorical=("purpose",), numeric=("int_rate",)))
