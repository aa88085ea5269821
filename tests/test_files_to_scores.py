"""From two CSV extracts to scored rows, and what the batch build reads."""

from __future__ import annotations

from conftest import SMALL

from creditmart import schemas
from creditmart.operators import clean, models
from creditmart.plans import catalog, training, warehouse
from creditmart.sources import files
from creditmart.sources.feeds import accepted_feed, rejected_feed


def test_row_keys_are_stable_and_tell_copies_apart(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, "a"), ("a", "b")], "x string, y string")
    keys = {r["row_key"] for r in files.with_row_key(df).collect()}
    assert len(keys) == 4
    assert keys == {r["row_key"] for r in files.with_row_key(df.repartition(3)).collect()}


def test_from_files_to_scores(spark, tmp_path):
    columns = catalog.PROFILED_ACCEPTED
    files.export_csv(rejected_feed(spark, SMALL).select(*schemas.REJECTED_COLUMNS), str(tmp_path / "r"))
    files.export_csv(accepted_feed(spark, SMALL).select(*columns), str(tmp_path / "a"))
    small = {"LogisticRegression": models.logistic_regression(maxIter=5)}
    for features in (models.WITH_RATES, models.RAW_ONLY):
        run = training.train_from_files(
            spark, str(tmp_path / "r"), str(tmp_path / "a"), str(tmp_path / "m"), columns=columns, features=features, classifiers=small
        )
        assert run.leaderboard.count() == 1 and run.test.count() > 0
    raw = [files.read_rejected_csv(spark, str(tmp_path / "r")), files.read_accepted_csv(spark, str(tmp_path / "a"), columns)]
    counts = warehouse.build_warehouse(*raw, str(tmp_path / "w"))
    table = files.read_layer(spark, str(tmp_path / "w/features/model_input"))
    assert "row_key" in table.columns and table.select("row_key").distinct().count() == counts["combined"] == table.count()
    new = clean.clean_rejected(files.with_row_key(raw[0]), carry=["row_key"]).drop("label")
    scored = training.score_new(new, str(tmp_path / "w/marts"), str(tmp_path / "m/LogisticRegression"))
    assert scored.count() == counts["rejected_clean"] and scored.where("prob_1 IS NULL").count() == 0
    assert models.load_model(str(tmp_path / "m/LogisticRegression")).feature_names == run.fitted["LogisticRegression"].feature_names


def test_missing_numbers_do_not_stop_a_raw_only_fit(spark):
    rows = catalog.detail(spark, SMALL)
    assert rows.where("dti IS NULL").count() > 0
    fitted = models.fit_all(rows, models.ordinal_features(models.RAW_ONLY), {"f": models.random_forest(numTrees=2, maxDepth=2, maxBins=8)})
    assert fitted["f"].score(rows).where("prob_1 IS NULL OR isnan(prob_1)").count() == 0
