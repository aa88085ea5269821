"""Trees grown from counts by category: the same splits as Spark's own learners, without a number per slot and row."""

from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from creditmart.operators import models, slot_trees


@pytest.fixture(scope="module")
def prepared(spark):
    """Rows whose numbers have few values, so that Spark's thresholds are exact too."""
    rows = spark.range(4000).selectExpr(
        "concat('p', pmod(xxhash64(id, 1), 9)) AS purpose", "concat('s', pmod(xxhash64(id, 2), 30)) AS addr_state", "concat('z', pmod(xxhash64(id, 3), 60)) AS zip_code",
        "CAST(pmod(xxhash64(id, 4), 12) AS double) AS loan_amnt", "CAST(pmod(xxhash64(id, 5), 11) AS int) AS emp_length", "CAST(nullif(pmod(xxhash64(id, 6), 14), 3) AS double) AS dti",
    )
    odd = "coalesce(dti, 0) * 3 + emp_length + 9 * CAST(purpose IN ('p1', 'p4') AS int) + 7 * CAST(zip_code < 'z3' AS int) + pmod(xxhash64(purpose, zip_code, loan_amnt, dti), 17)"
    rows = rows.withColumn("label", F.expr(f"CAST({odd} > 36 AS int)")).localCheckpoint()
    features = models.one_hot_features(models.RAW_ONLY).fit(rows)
    transformed = features.transform(rows)
    return transformed, slot_trees.blocks(features, transformed)


def scores(model, rows) -> list[float]:
    return [r[0] for r in model.transform(rows).select(vector_to_array("rawPrediction")[1]).collect()]


def test_blocks_are_the_slots_of_the_vector(prepared):
    transformed, blocks = prepared
    assert [(b.first, b.slots) for b in blocks] == [(0, 10), (10, 31), (41, 61), (102, 0), (103, 0), (104, 0)]
    assert len(models.feature_names(transformed)) == 105


def test_boosting_equals_sparks_own(prepared):
    transformed, blocks = prepared
    booster = models.boosted_trees(maxIter=6, maxDepth=3, subsamplingRate=1.0)
    ours, theirs = slot_trees.fit(booster, transformed, blocks), booster.fit(transformed)
    assert scores(ours, transformed) == pytest.approx(scores(theirs, transformed), abs=1e-5)
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-5)
    assert ours.numFeatures == theirs.numFeatures and ours.treeWeights == theirs.treeWeights


def test_one_tree_more_changes_none_before(prepared):
    transformed, blocks = prepared
    grower = slot_trees.Grower(models.boosted_trees(maxDepth=2), transformed, blocks)
    few, more = grower.grow(2), grower.grow(7)
    grower.close()
    again = slot_trees.fit(models.boosted_trees(maxIter=7, maxDepth=2), transformed, blocks)
    assert [t.toDebugString.split("\n", 1)[1] for t in few.trees] == [t.toDebugString.split("\n", 1)[1] for t in more.trees[:2]]
    assert scores(more, transformed) == scores(again, transformed)


def test_a_forest_has_the_depth_bags_and_slots_asked_for(prepared):
    transformed, blocks = prepared
    forest = slot_trees.fit(models.random_forest(numTrees=12, maxDepth=4), transformed, blocks)
    theirs = models._without_summary(models.random_forest(numTrees=12, maxDepth=4).fit(transformed))
    assert forest.getNumTrees == 12 and max(t.depth for t in forest.trees) <= 4
    assert len({t.toDebugString for t in forest.trees}) == 12  # bags and slots differ
    area = lambda m: models.evaluator_areas(m.transform(transformed).select("label", vector_to_array("probability")[1].alias("prob_1")))["areaUnderROC"]
    assert area(forest) > area(theirs) - 0.05 and area(forest) > 0.6
    stump = slot_trees.fit(models.random_forest(numTrees=2, maxDepth=0), transformed, blocks)
    assert all(t.depth == 0 for t in stump.trees)


def test_nodes_in_several_jobs_give_the_same_trees(prepared, monkeypatch):
    transformed, blocks = prepared
    whole = slot_trees.fit(models.random_forest(numTrees=3, maxDepth=4), transformed, blocks)
    monkeypatch.setattr(slot_trees, "CELLS", 500)
    assert scores(slot_trees.fit(models.random_forest(numTrees=3, maxDepth=4), transformed, blocks), transformed) == scores(whole, transformed)


def test_fitting_uses_them_where_there_are_slots(prepared, monkeypatch):
    transformed, _ = prepared
    rows = transformed.select("label", *models.RAW_ONLY.columns)
    used = []
    monkeypatch.setattr(slot_trees, "fit", lambda clf, *a, f=slot_trees.fit: used.append(clf) or f(clf, *a))
    small = {"GBT": models.boosted_trees(maxIter=2, maxDepth=2), "RandomForest": models.random_forest(numTrees=2, maxDepth=2), "LogisticRegression": models.logistic_regression(maxIter=3)}
    models.fit_all(rows, models.one_hot_features(models.RAW_ONLY), small)
    assert len(used) == 2
    models.fit_all(rows, models.ordinal_features(models.RAW_ONLY), {"GBT": small["GBT"]})
    assert len(used) == 2


def test_boosting_goes_on_from_the_trees_that_are_there(prepared, monkeypatch):
    rows = prepared[0].select("label", *models.RAW_ONLY.columns).withColumn("is_validation", F.expr("pmod(xxhash64(loan_amnt, dti, zip_code, purpose), 4) = 0"))
    grown = []
    monkeypatch.setattr(models.GBTClassifier, "fit", lambda *_: pytest.fail("fitted by a number a slot and row"))
    monkeypatch.setattr(slot_trees.Grower, "_grow", lambda self, trees, f=slot_trees.Grower._grow: grown.append(trees) or f(self, trees))
    run = models.boost_with_patience(rows, models.one_hot_features(models.RAW_ONLY), rounds=9, patience=4, maxDepth=2)
    assert sum(grown) == run.rounds <= 9  # 8 rounds first, then one more if need be, none twice
    assert run.fitted.classifier.getNumTrees == run.best_round


def test_rows_without_a_label_are_refused(prepared):
    transformed, blocks = prepared
    for label in ("NULL", "2"):
        with pytest.raises(ValueError, match="labels must be 0 or 1"):
            slot_trees.Grower(models.boosted_trees(), transformed.withColumn("label", F.expr(f"CASE WHEN dti < 1 THEN {label} ELSE label END")), blocks)
