"""Feature pipelines and classifiers on Spark ML, and reports about fitted models."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditmart import rules
from creditmart.operators import evaluate as ev
from creditmart.operators import slot_trees
from creditmart.operators.features import check_no_leakage
from creditmart.sources.stage import stage, stage_folder

SEED = 42


@dataclass(frozen=True)
class FeatureSet:
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.categorical, *self.numeric)


# --- fixed values: the two feature sets -----------------------------------------------
WITH_RATES = FeatureSet(
    categorical=("purpose", "addr_state"),
    numeric=(
        "loan_amnt", "emp_length", "dti",
        "state_approval_rate", "state_avg_dti",
        "purpose_approval_rate", "purpose_avg_loan_amnt",
        "zip_approval_rate",
    ),
)
RAW_ONLY = FeatureSet(
    categorical=("purpose", "addr_state", "zip_code"),
    numeric=("loan_amnt", "emp_length", "dti"),
)


# --- feature stages -------------------------------------------------------------------

_FILLED = "_filled"


def _fill(features: FeatureSet) -> SQLTransformer:
    """Missing numbers take their defaults inside the pipeline, so a saved model fills them too."""
    filled = (f"coalesce(CAST({c} AS double), {float(rules.FEATURE_DEFAULTS[c])}D) AS {c}{_FILLED}" for c in features.numeric)
    return SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__")


def _numbers(features: FeatureSet) -> list[str]:
    return [c + _FILLED for c in features.numeric]


def one_hot_features(features: FeatureSet) -> Pipeline:
    """Index (unseen values kept as an own slot), one-hot encode and assemble."""
    check_no_leakage(features.columns)
    index = [f"{c}_idx" for c in features.categorical]
    vector = [f"{c}_vec" for c in features.categorical]
    return Pipeline(
        stages=[
            _fill(features),
            StringIndexer(inputCols=list(features.categorical), outputCols=index, handleInvalid="keep"),
            OneHotEncoder(inputCols=index, outputCols=vector, handleInvalid="keep"),
            VectorAssembler(
                inputCols=[*vector, *_numbers(features)], outputCol="features", handleInvalid="keep"
            ),
        ]
    )


def ordinal_features(features: FeatureSet) -> Pipeline:
    """Categories as plain numbers, their alphabetical position, instead of one-hot slots.

    The codes are recomputed as expressions, which drops the nominal tag of the indexed
    columns: trees then split them as numbers and need no bin per category.
    """
    check_no_leakage(features.columns)
    index = [f"{c}_idx" for c in features.categorical]
    codes = [f"{c}_code" for c in features.categorical]
    plain = ", ".join(f"{i} + 0.0D AS {c}" for i, c in zip(index, codes, strict=True))
    return Pipeline(
        stages=[
            _fill(features),
            StringIndexer(
                inputCols=list(features.categorical),
                outputCols=index,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            SQLTransformer(statement=f"SELECT *, {plain} FROM __THIS__"),
            VectorAssembler(
                inputCols=[*_numbers(features), *codes], outputCol="features", handleInvalid="keep"
            ),
        ]
    )


def feature_names(transformed: DataFrame, column: str = "features") -> list[str]:
    """Slot names from the vector's own metadata, in slot order.

    Category labels alone are too few: every encoded column has a further slot for unseen
    values, which shifts all names after it.
    """
    groups = transformed.schema[column].metadata["ml_attr"]["attrs"].values()
    slots = {a["idx"]: a["name"].removesuffix(_FILLED) for group in groups for a in group}
    return [slots[i] for i in range(len(slots))]


# --- classifiers: fixed values --------------------------------------------------------------


def logistic_regression(**overrides) -> LogisticRegression:
    settings = {"maxIter": 100, "regParam": 0.01, "elasticNetParam": 0.0}
    return LogisticRegression(labelCol="label", **{**settings, **overrides})


def random_forest(**overrides) -> RandomForestClassifier:
    settings = {"numTrees": 50, "maxDepth": 6, "maxBins": 16, "seed": SEED}
    return RandomForestClassifier(labelCol="label", **{**settings, **overrides})


def boosted_trees(**overrides) -> GBTClassifier:
    settings = {
        "maxIter": 20, "maxDepth": 5, "maxBins": 16, "stepSize": 0.1, "subsamplingRate": 0.8, "seed": SEED,
    }
    return GBTClassifier(labelCol="label", **{**settings, **overrides})


def boosted_trees_early_stop(flag: str = "is_validation", **overrides) -> GBTClassifier:
    """Many small steps, ended once the rows flagged in ``flag`` stop improving.

    Boosting checkpoints its row-to-residual lineage every ten rounds when the session
    names a checkpoint folder.
    """
    settings = {"maxIter": 500, "maxDepth": 7, "stepSize": 0.05, "validationTol": 0.01}
    return boosted_trees(validationIndicatorCol=flag, checkpointInterval=10, **{**settings, **overrides})


def standard_classifiers() -> dict[str, Estimator]:
    return {
        "LogisticRegression": logistic_regression(),
        "RandomForest": random_forest(),
        "GBT": boosted_trees(),
    }


def raw_only_classifiers() -> dict[str, Estimator]:
    """Larger trees with full bins, as used where no rate features help."""
    return {
        "LogisticRegression": logistic_regression(),
        "RandomForest": random_forest(numTrees=100, maxDepth=8, maxBins=32),
        "GBT": boosted_trees(maxIter=50, maxDepth=6, maxBins=32, subsamplingRate=1.0),
    }


# --- fitting ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fitted:
    name: str
    pipeline: PipelineModel
    feature_names: tuple[str, ...]

    @property
    def classifier(self) -> Model:
        return self.pipeline.stages[-1]

    def score(self, rows: DataFrame) -> DataFrame:
        """Rows with ``prediction`` (int) and ``prob_1``; vectors and index columns dropped."""
        scored = self.pipeline.transform(rows)
        return scored.select(
            *rows.columns,
            F.col("prediction").cast("int").alias("prediction"),
            vector_to_array("probability")[1].alias("prob_1"),
        )


def _without_summary(model: Model) -> Model:
    """The model as saved and loaded: a training summary holds the session, which cannot be sent
    to tasks once anything in it has been observed."""
    if not getattr(model, "hasSummary", False):
        return model
    path = stage_folder(SparkSession.active(), "fitted")
    model.write().save(path)
    return type(model).load(path)


def fit_all(train: DataFrame, features: Pipeline, classifiers: dict[str, Estimator]) -> dict[str, Fitted]:
    """Fit the feature stages once and every classifier on the same assembled vectors.

    The vectors are cached for the iterations and released afterwards; each result is a
    full pipeline (features and classifier) that takes raw rows. Trees on one-hot slots are grown from
    the indexed columns (``slot_trees``): Spark's learners hold a number for every slot of every row.
    """
    feature_model = features.fit(train)
    keep = [c for c in ("label", "is_validation") if c in train.columns]
    transformed = feature_model.transform(train)
    blocks = slot_trees.blocks(feature_model, transformed) or []
    vectors = transformed.select(*keep, "features", *(b.column for b in blocks))
    names = tuple(feature_names(vectors))
    vectors.persist()

    def fit(clf: Estimator) -> Model:
        return slot_trees.fit(clf, vectors, blocks) if blocks and slot_trees.grows(clf) else _without_summary(clf.fit(vectors))

    try:
        return {name: Fitted(name, PipelineModel([*feature_model.stages, fit(clf)]), names) for name, clf in classifiers.items()}
    finally:
        vectors.unpersist()


# --- boosting that ends when the area under the curve does --------------------------------------


@dataclass(frozen=True)
class Boosted:
    """A boosted model cut to its best round, and the areas of every round that was fitted."""

    fitted: Fitted
    margins: DataFrame
    areas: tuple[float, ...]
    best_round: int
    stopped: bool

    @property
    def rounds(self) -> int:
        return len(self.areas)


def running_margins(model: Model, vectors: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``*keep, round, prob_1``: the margin of every row after every round, from one scoring pass.

    Each row's leaves (one a tree) are looked up among the leaf values of the trees, and summed as they come.
    """
    trees = re.split(r"Tree \d+ \(weight ([^)]+)\):", model.toDebugString)[1:]
    values = [[float(w) * float(v) for v in re.findall(r"Predict: (\S+)", text)] for w, text in zip(trees[::2], trees[1::2], strict=True)]
    leaves = model.copy().setLeafCol("_leaf").transform(vectors).select(*keep, vector_to_array("_leaf").alias("_leaves"))
    steps = "transform(_leaves, (leaf, i) -> element_at(_values[i], CAST(leaf AS int) + 1))"
    running = "aggregate(_steps, CAST(array() AS array<double>), (sums, x) -> concat(sums, array(coalesce(get(sums, size(sums) - 1), 0.0D) + x)))"
    return (
        leaves.withColumn("_values", F.from_json(F.lit(json.dumps(values)), "array<array<double>>"))
        .selectExpr(*keep, f"{steps} AS _steps")
        .selectExpr(*keep, f"posexplode({running}) AS (round, prob_1)")
        .selectExpr(*keep, "round + 1 AS round", "prob_1")
    )


def stopping_round(areas: Sequence[float], patience: int) -> tuple[int, bool]:
    """(best round, whether ``patience`` rounds without a better one have passed), rounds from 1; ties go to the earlier."""
    best = 0
    for i, area in enumerate(areas):
        if area > areas[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def truncated(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first rounds."""
    context = SparkSession.active().sparkContext
    jvm, gateway, java = context._jvm, context._gateway, model._java_obj
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(java.trees()[:rounds], java.treeWeights()[:rounds], strict=True)):
        trees[i], weights[i] = tree, weight
    cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights)
    return GBTClassificationModel(java.copyValues(cut, java.extractParamMap()))


def boost_with_patience(
    train: DataFrame, features: Pipeline, flag: str = "is_validation", rounds: int = 500, patience: int = 50, keep: Sequence[str] = (), **overrides
) -> Boosted:
    """Boosted trees on the rows not flagged, ended once the exact area on the flagged rows has not risen for ``patience`` rounds.

    The number of rounds is doubled until the rule ends it or ``rounds`` are reached. Trees on one-hot slots go on from
    those that are there; Spark's learner fits all anew, at most twice the work of the last fit. Every fit is scored in one
    pass, its areas are computed together, and the model keeps its best round's trees only. ``keep`` names columns to carry
    into the flagged rows' margins.
    """
    settings = {"maxDepth": 7, "stepSize": 0.05, "checkpointInterval": 10, **overrides}
    feature_model = features.fit(train.where(f"NOT {flag}"))
    transformed = feature_model.transform(train)
    blocks = slot_trees.blocks(feature_model, transformed) or []
    vectors = transformed.select(*dict.fromkeys([*keep, "label", flag, "features", *(b.column for b in blocks)]))
    names = tuple(feature_names(vectors))
    vectors = stage(vectors, "boosting-vectors")
    learn, check = vectors.where(f"NOT {flag}").drop(flag), vectors.where(flag).drop(flag)
    booster = boosted_trees(maxIter=rounds, **settings)
    grower = slot_trees.Grower(booster, learn, blocks) if blocks and slot_trees.grows(booster) else None
    fit = min(rounds, 2 * patience)
    try:
        while True:
            model = grower.grow(fit) if grower else boosted_trees(maxIter=fit, **settings).fit(learn)
            scores = stage(running_margins(model, check, [*keep, "label"]), "boosting-margins")
            areas = tuple(r["auc_roc"] for r in ev.auc_rank(scores, ["round"]).orderBy("round").collect())  # a row per round
            best, stopped = stopping_round(areas, patience)
            if stopped or fit >= rounds:
                cut = PipelineModel([*feature_model.stages, truncated(model, best)])
                return Boosted(Fitted("GBT", cut, names), scores, areas, best, stopped)
            fit = min(rounds, 2 * fit)
    finally:
        if grower:
            grower.close()


_NAMES = ".features"


def save_model(fitted: Fitted, folder: str) -> str:
    """Save the pipeline, and the names of its feature slots beside it."""
    path = f"{folder.rstrip('/')}/{fitted.name}"
    fitted.pipeline.write().overwrite().save(path)
    spark = SparkSession.active()
    names = spark.createDataFrame(list(enumerate(fitted.feature_names)), "slot int, name string")
    names.coalesce(1).write.mode("overwrite").parquet(f"{path}{_NAMES}")
    return path


def load_model(path: str, name: str | None = None) -> Fitted:
    path = path.rstrip("/")
    names = SparkSession.active().read.parquet(f"{path}{_NAMES}").orderBy("slot").collect()
    return Fitted(name or path.rsplit("/", 1)[-1], PipelineModel.load(path), tuple(r["name"] for r in names))


# --- reports --------------------------------------------------------------------------------


def _importance_table(spark: SparkSession, pairs: Sequence[tuple[str, float]], top: int) -> DataFrame:
    return rank_importance(spark.createDataFrame(list(pairs), "feature string, importance double"), top)


def rank_importance(importances: DataFrame, top: int) -> DataFrame:
    """``feature, importance`` ranked with a running total. There is one row per feature slot, so one task is enough."""
    ranked = Window.orderBy(F.desc("importance"), "feature")
    so_far = ranked.rowsBetween(Window.unboundedPreceding, 0)
    return (
        importances.withColumn("rank", F.row_number().over(ranked))
        .withColumn("cumulative", F.sum("importance").over(so_far))
        .where(F.col("rank") <= top)
    )


def tree_importance(spark: SparkSession, fitted: Fitted, top: int = 15) -> DataFrame:
    values = fitted.classifier.featureImportances.toArray()
    return _importance_table(spark, [(n, float(v)) for n, v in zip(fitted.feature_names, values, strict=True)], top)


def linear_importance(spark: SparkSession, fitted: Fitted, top: int = 10) -> DataFrame:
    values = fitted.classifier.coefficients.toArray()
    return _importance_table(
        spark, [(n, abs(float(v))) for n, v in zip(fitted.feature_names, values, strict=True)], top
    )


def evaluator_areas(predictions: DataFrame) -> dict[str, float]:
    """Spark's own binned areas from a ``rawPrediction`` or probability column."""
    return {
        metric: BinaryClassificationEvaluator(
            labelCol="label", rawPredictionCol="prob_1", metricName=metric
        ).evaluate(predictions)
        for metric in ("areaUnderROC", "areaUnderPR")
    }


def leaderboard(models: dict[str, Fitted], test: DataFrame) -> DataFrame:
    """One row of metrics per model, the best exact AUC marked.

    Scores are staged: two reports read them, and scoring is the costly part.
    """
    rows = []
    for name, fitted in models.items():
        scored = stage(fitted.score(test).select("label", "prediction", "prob_1"), f"scored-{name}")
        areas = ev.auc_rank(scored).select(F.struct("auc_roc", "auc_pr")).scalar()
        metrics = ev.classification_metrics(scored).withColumn("_areas", areas)
        rows.append(metrics.select(F.lit(name).alias("model"), "_areas.*", *metrics.columns).drop("_areas"))
    best = Window.orderBy(F.desc("auc_roc"), "model")  # one row per model
    return reduce(DataFrame.unionByName, rows).withColumn("is_best", F.row_number().over(best) == 1)
