"""Training run: undersample, split, fit, compare, report, save."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.base import Estimator
from pyspark.sql import DataFrame, SparkSession

from creditmart import schemas
from creditmart.operators import clean, features as rate_features, models, sampling
from creditmart.plans import warehouse
from creditmart.sources import files
from creditmart.sources.stage import stage


@dataclass(frozen=True)
class TrainingRun:
    fitted: dict[str, models.Fitted]
    train: DataFrame
    test: DataFrame
    leaderboard: DataFrame


def leak_safe_rows(detail: DataFrame, key: str) -> DataFrame:
    """Feature rows of staged detail: rates out of the training part only, attached to all rows."""
    split = sampling.split_hash(detail, key)
    rated = rate_features.attach_rates(split, split.where("split = 'train'"))
    return rated.select(key, *schemas.FEATURES.names)


def train_from_files(spark: SparkSession, rejected_csv: str, accepted_csv: str, save_to: str, **options) -> TrainingRun:
    """From the two extracts to saved models. ``options`` go to ``train_and_compare`` (and ``columns`` to the reader)."""
    columns = options.pop("columns", schemas.ACCEPTED_COLUMNS)
    rejected = files.with_row_key(files.read_rejected_csv(spark, rejected_csv), "r-")
    accepted = files.with_row_key(files.read_accepted_csv(spark, accepted_csv, columns), "a-")
    key = "row_key"
    detail = stage(clean.combine(clean.clean_rejected(rejected, carry=[key]), clean.clean_accepted(accepted, carry=[key])), "detail")
    return train_and_compare(leak_safe_rows(detail, key), key, save_to=save_to, **options)


def score_new(rows: DataFrame, lookup_folder: str, model_path: str) -> DataFrame:
    """Cleaned rows without labels, scored by a saved model with the published lookups."""
    rates = warehouse.read_rates(rows.sparkSession, lookup_folder, warehouse.LOOKUP_TABLES)
    return models.load_model(model_path).score(rate_features.join_rates(rows, rates))


def train_and_compare(
    model_input: DataFrame,
    key: str,
    features: models.FeatureSet = models.WITH_RATES,
    classifiers: dict[str, Estimator] | None = None,
    save_to: str | None = None,
) -> TrainingRun:
    """Balance to 2:1, split 80/20 by key hash, fit every classifier on shared features.

    The balanced, split rows are staged once: fitting and evaluation read them many times.
    """
    balanced = sampling.undersample_hash(model_input, key)
    split = stage(sampling.split_hash(balanced, key).select(key, "label", *features.columns, "split"), "split")
    train = split.where("split = 'train'").drop("split")
    test = split.where("split = 'test'").drop("split")
    fitted = models.fit_all(
        train, models.one_hot_features(features), classifiers or models.standard_classifiers()
    )
    if save_to:
        for model in fitted.values():
            models.save_model(model, save_to)
    return TrainingRun(fitted, train, test, models.leaderboard(fitted, test))
