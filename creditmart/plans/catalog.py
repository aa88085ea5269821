"""Named queries over the supplied tables: one per operator, whole tables throughout."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart import rules, schemas
from creditmart.functions import scalars as sc
from creditmart.operators import clean, evaluate, features, marts, models, profile, rollups, sampling, states, summaries
from creditmart.plans import refresh, training, warehouse
from creditmart.plans.warehouse import ReportInputs, reporting_marts
from creditmart.sources import files, publish
from creditmart.sources.feeds import accepted_feed, feeds, rejected_feed, scored_applications, table
from creditmart.sources.stage import stage, stage_folder

Query = Callable[[SparkSession, str], DataFrame]

DETAIL_NUMBERS = ("loan_amnt", "dti")
PROFILED_DETAIL = ("loan_amnt", "purpose", "addr_state", "emp_length", "dti", "zip_code")
PROFILED_REJECTED = schemas.REJECTED_COLUMNS
PROFILED_ACCEPTED_NUMBERS = ("int_rate", "loan_amnt", "annual_inc", "dti", "fico_range_low")
PROFILED_ACCEPTED_CATEGORIES = (
    "loan_status", "grade", "sub_grade", "term", "home_ownership", "issue_d", "purpose",
)
# The supplied tables have no counterpart of three accepted columns, which feed no output.
PROFILED_ACCEPTED = tuple(
    c for c in schemas.ACCEPTED_COLUMNS if c not in ("verification_status", "installment", "funded_amnt")
)
TOP_VALUES = 20
SAMPLE_ROWS = 1000


# --- inputs ----------------------------------------------------------------------------


def detail_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_rejected(rejected_feed(spark, sf_dir), carry=["app_id"])


def detail_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_accepted(accepted_feed(spark, sf_dir), carry=["app_id"])


def detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected, accepted = feeds(spark, sf_dir)
    return clean.combine(
        clean.clean_rejected(rejected, carry=["app_id"]), clean.clean_accepted(accepted, carry=["app_id"])
    )


def staged_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail rows for operators that read them several times."""
    return stage(detail(spark, sf_dir), "detail")


def report_inputs(spark: SparkSession, sf_dir: str, staged: bool = False) -> ReportInputs:
    return ReportInputs.of(*feeds(spark, sf_dir), staged)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.with_prediction(scored_applications(spark, sf_dir))


# --- registration ------------------------------------------------------------------------

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _on_detail(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    _QUERIES[name] = lambda spark, sf_dir: operator(detail(spark, sf_dir))


def _on_feeds(name: str, operator: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    _QUERIES[name] = lambda spark, sf_dir: operator(*feeds(spark, sf_dir))


def _on_reports(name: str, build: Callable[[ReportInputs], DataFrame]) -> None:
    _QUERIES[name] = lambda spark, sf_dir: build(report_inputs(spark, sf_dir))


# --- detail and summaries -----------------------------------------------------------------


@query
def dwd_rejected_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detail_rejected(spark, sf_dir)


@query
def dwd_accepted_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detail_accepted(spark, sf_dir)


@query
def dwd_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detail(spark, sf_dir)


_on_detail("dws_geo", summaries.geo_stats)
_on_detail("dws_purpose", summaries.purpose_stats)
_on_detail("dws_zip", summaries.zip_stats)
_on_detail("dws_emp", summaries.employment_stats)
_on_detail("label_distribution", partial(profile.value_frequency, column="label"))
_on_detail("value_frequency", partial(profile.value_frequency, column="purpose"))
_on_detail("missing_rates", partial(profile.missing_rates, columns=PROFILED_DETAIL))
_on_detail("class_balance", sampling.class_balance)
_on_detail("kpi_metrics", summaries.kpi_metrics)
_on_detail("state_ranking", lambda d: profile.state_ranking(summaries.geo_stats(d)))

@query
def drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each feed by the rules they fail; they add up to the feed."""
    rejected, accepted = feeds(spark, sf_dir)
    parts = (clean.drop_reasons(raw, is_accepted).withColumn("src", F.lit(src)) for src, raw, is_accepted in (("rejected", rejected, False), ("accepted", accepted, True)))
    return reduce(DataFrame.unionByName, parts)


@query
def drop_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the cleaning pass counted on the way: rows, rows kept, and rows by the first rule they fail, beside the rows written."""
    rows = []
    for src, raw, is_accepted in (("rejected", rejected_feed(spark, sf_dir), False), ("accepted", accepted_feed(spark, sf_dir), True)):
        folder = stage_folder(spark, f"{src}-counted")
        counts = warehouse.build_counted_detail(raw, is_accepted, folder)
        rows += [(src, name, n) for name, n in counts.items()] + [(src, "written", files.read_layer(spark, folder).count())]
    return spark.createDataFrame(rows, "src string, figure string, cnt long")


# --- files -------------------------------------------------------------------------------


@query
def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract in which some lines have an open quote, a field too many or too few: its rows, and the lines set aside."""
    columns = schemas.REJECTED_COLUMNS
    quoted = [f"concat('\"', replace(coalesce({c}, ''), '\"', ''), '\"')" for c in columns]
    line = f"concat_ws(',', {', '.join(quoted)})"
    broken = (
        f"CASE WHEN app_id % 40 = 3 THEN concat(app_id, ',\"open,', {quoted[2]}) WHEN app_id % 40 = 7 THEN concat({line}, ',', app_id) "
        f"WHEN app_id % 40 = 11 THEN concat(app_id, ',', {quoted[1]}) ELSE {line} END AS value"
    )
    folder = stage_folder(spark, "broken-csv")
    rejected_feed(spark, sf_dir).selectExpr(broken).write.text(f"{folder}/extract")
    rows, bad, counts = files.read_with_quarantine(spark, f"{folder}/extract", f"{folder}/parsed", columns, header=False)
    both = rows.withColumns({"line": F.lit(None).cast("string"), "reason": F.lit(None).cast("string")}).unionByName(
        bad.select("line", "reason"), allowMissingColumns=True
    )
    return both.withColumn("lines", F.lit(counts["lines"]).cast("long"))


@query
def export_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail table exported as CSV and read again with its declared types."""
    path = stage_folder(spark, "export")
    files.export_csv(detail(spark, sf_dir).select(*schemas.DETAIL.names), path)
    return files.read_detail_csv(spark, path)


def _csv_copy(feed: DataFrame, columns: Sequence[str], name: str) -> str:
    path = stage_folder(feed.sparkSession, name)
    files.export_csv(feed.select(*columns), path)
    return path


@query
def csv_rejected_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected feed as a CSV extract: read by position, cleaned, written as a layer, read back."""
    raw = files.read_rejected_csv(spark, _csv_copy(rejected_feed(spark, sf_dir), schemas.REJECTED_COLUMNS, "rejected-csv"))
    path = stage_folder(spark, "rejected-layer")
    files.write_layer(clean.clean_rejected(raw), path)
    return files.read_layer(spark, path)


@query
def csv_accepted_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the accepted feed, read by name."""
    raw = files.read_accepted_csv(
        spark, _csv_copy(accepted_feed(spark, sf_dir), PROFILED_ACCEPTED, "accepted-csv"), PROFILED_ACCEPTED
    )
    path = stage_folder(spark, "accepted-layer")
    files.write_layer(clean.clean_accepted(raw), path)
    return files.read_layer(spark, path)


# --- reporting marts ----------------------------------------------------------------------

for _name, _mart in reporting_marts().items():
    _on_reports(_name, _mart.build)
_on_reports("geo_map_exact", lambda i: marts.geo_map_exact(i.rejected_any_date, i.accepted))
_on_reports("reject_time_rollup", lambda i: summaries.reject_by_time(i.rejected))
_on_reports("reject_risk", lambda i: summaries.reject_by_risk(i.rejected))
_on_reports("reject_customer", lambda i: summaries.reject_by_customer(i.rejected))
_on_reports("reject_product", lambda i: summaries.reject_by_product(i.rejected))


# --- the same from mergeable states ---------------------------------------------------------


def _on_states(name: str, build: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    _QUERIES[name] = lambda spark, sf_dir: build(*warehouse.feed_states(*feeds(spark, sf_dir)))


def _on_detail_states(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    _QUERIES[name] = lambda spark, sf_dir: build(stage(states.detail_states(detail(spark, sf_dir)), "detail-states"))


for _name, _rollup in warehouse.ROLLUPS.items():
    _on_states(f"rollup_{_name}", _rollup)
_on_states("rollup_reject_time", lambda rejected, accepted: rollups.reject_by_time(rejected))
_on_states("rollup_reject_risk", lambda rejected, accepted: rollups.reject_by_risk(rejected))
_on_states("rollup_reject_customer", lambda rejected, accepted: rollups.reject_by_customer(rejected))
_on_states("rollup_reject_product", lambda rejected, accepted: rollups.reject_by_product(rejected))
_on_states("exact_sums", lambda rejected, accepted: rollups.exact_sums(accepted))
_on_detail_states("rollup_dws_geo", rollups.geo_stats)
_on_detail_states("rollup_dws_purpose", rollups.purpose_stats)
_on_detail_states("rollup_dws_zip", rollups.zip_stats)
_on_detail_states("rollup_dws_emp", rollups.employment_stats)
_on_detail_states("rollup_kpi", rollups.kpi_metrics)


@query
def refresh_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly trend of a store that was filled before half of two months' rows came, and then refreshed by these months."""
    rejected, accepted = feeds(spark, sf_dir)
    months = ["1995-03", "1997-11"]
    late_rejected = "substring(application_date, 1, 7) IN ('1995-03', '1997-11') AND app_id % 2 = 0"
    late_accepted = "issue_d IN ('Mar-1995', 'Nov-1997') AND app_id % 2 = 0"
    folder = stage_folder(spark, "store")
    refresh.load(rejected.where(f"NOT coalesce({late_rejected}, false)"), accepted.where(f"NOT coalesce({late_accepted}, false)"), folder)
    refresh.refresh(rejected, accepted, months, folder)
    return refresh.marts(rejected, accepted, folder)["trend_monthly"]


@query
def purpose_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    titled = rejected_feed(spark, sf_dir).transform(clean.with_purpose("loan_title"))
    return titled.select("app_id", "loan_title", "purpose")


@query
def document_purpose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The purpose rules over whole free-text documents."""
    return table(spark, sf_dir, "documents").transform(clean.with_purpose("text")).select("doc_id", "purpose")


@query
def status_simplify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted_feed(spark, sf_dir).selectExpr(
        "app_id",
        f"{sc.simplify_status('loan_status')} AS status",
        f"{sc.is_charged_off('loan_status')} AS is_charged_off",
    )


@query
def publish_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = summaries.geo_stats(detail(spark, sf_dir))
    return publish.conform(summary, "geo_lookup")


@query
def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared columns of a published table, lengths and precision included, and what its rows hold."""
    return profile.schema_report(publish_conform(spark, sf_dir))


@query
def mart_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every published table, counted in the files that were published."""
    folder = stage_folder(spark, "published")
    paths = warehouse.build_marts(*feeds(spark, sf_dir), folder) | warehouse.build_lookups(staged_detail(spark, sf_dir), folder)
    return profile.row_counts({name: spark.read.parquet(path) for name, path in paths.items()})


# --- profiling ----------------------------------------------------------------------------

_on_feeds("feed_volumes", profile.feed_volumes)
_on_feeds("feed_compare", profile.feed_compare)
_on_feeds("date_span", profile.date_span)
_on_feeds("year_counts", profile.year_counts)
_on_feeds("state_compare", profile.state_compare)
_on_feeds("missing_bands", lambda rej, acc: profile.missing_bands(acc, PROFILED_ACCEPTED))
_on_feeds("missing_rates_rejected", lambda rej, acc: profile.missing_rates(rej, PROFILED_REJECTED))
_on_feeds("pct_of_total", lambda rej, acc: profile.pct_of_total(rej, "loan_title", TOP_VALUES))
_on_feeds("pct_of_total_accepted", lambda rej, acc: profile.pct_of_total(acc, "purpose", TOP_VALUES))
_on_feeds(
    "topk_states",
    lambda rej, acc: profile.top_k(profile.value_frequency(rej, "state"), "cnt", "state", 10),
)
_on_feeds(
    "nonconforming_values",
    lambda rej, acc: profile.nonconforming_values(
        profile.rejected_conformance(rej).unionByName(profile.accepted_conformance(acc))
    ),
)
_on_feeds(
    "categorical_profile",
    lambda rej, acc: profile.categorical_profile(acc, PROFILED_ACCEPTED_CATEGORIES, k=10),
)
_on_feeds(
    "crosstab_grade_status",
    lambda rej, acc: profile.crosstab(
        acc,
        "grade",
        "loan_status",
        {s: "_".join("".join(ch if ch.isalnum() else " " for ch in s.lower()).split()) for s in rules.RAW_STATUSES},
    ),
)
_on_feeds("quality_flags", profile.quality_flags)


def _deduped(feed: DataFrame, src: str, columns: Sequence[str]) -> DataFrame:
    """A feed with a seventh of its rows delivered twice, without the copies: rows equal in every column."""
    twice = feed.unionByName(feed.where("app_id % 7 = 0"))
    once = clean.dedupe(twice, keys=["app_id", *columns], order=[])
    return once.selectExpr(f"'{src}' AS src", f"concat_ws('|', {', '.join(columns)}) AS row_key", "app_id", "n_copies")


_on_feeds(
    "dedupe",
    lambda rej, acc: _deduped(rej, "rejected", PROFILED_REJECTED).unionByName(_deduped(acc, "accepted", PROFILED_ACCEPTED)),
)


def _numbers(spark: SparkSession, sf_dir: str, income: bool) -> DataFrame:
    rej, acc = feeds(spark, sf_dir)
    both = profile.rejected_numbers(rej).unionByName(profile.accepted_numbers(acc, income))
    return stage(both, "numbers")


@query
def quantiles_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(detail(spark, sf_dir).select("label", *DETAIL_NUMBERS), "quantiles")
    return profile.quantiles_by_label(rows, DETAIL_NUMBERS)


@query
def quantiles_by_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distribution(_numbers(spark, sf_dir, income=False), ["src", "field"])


@query
def iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.iqr_outliers(_numbers(spark, sf_dir, income=True), ["src", "field"])


@query
def numeric_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(accepted_feed(spark, sf_dir).select(*PROFILED_ACCEPTED_NUMBERS), "numeric-profile")
    return profile.numeric_profile(rows, PROFILED_ACCEPTED_NUMBERS)


@query
def sample_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(
        rejected_feed(spark, sf_dir).select("app_id", "loan_amnt_raw", "dti_raw", "risk_score"), "sample"
    )
    return sampling.sample_scan(rows, "app_id", SAMPLE_ROWS)


# --- features ------------------------------------------------------------------------------


@query
def ads_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.model_input(staged_detail(spark, sf_dir), carry=["app_id"])


@query
def describe_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.model_input(staged_detail(spark, sf_dir))
    return profile.describe(rows, ["state_approval_rate", "purpose_approval_rate"])


@query
def oof_target_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.out_of_fold_rates(staged_detail(spark, sf_dir), "app_id")
    return rows.select(
        "app_id", "label", "fold",
        "oof_state_approval_rate", "oof_purpose_approval_rate", "oof_zip_approval_rate",
    )


@query
def score_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows with the rates of lookups published from the training rows, as new rows are scored."""
    split = stage(sampling.split_hash(detail(spark, sf_dir), "app_id"), "split")
    train, test = split.where("split = 'train'"), split.where("split = 'test'").drop("split")
    folder = stage_folder(spark, "lookups")
    warehouse.build_lookups(train, folder)
    rates = warehouse.read_rates(spark, folder, warehouse.LOOKUP_TABLES)
    return features.join_rates(test, rates).select("app_id", *schemas.FEATURES.names)


# --- sampling -------------------------------------------------------------------------------


@query
def undersample_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.undersample_hash(detail(spark, sf_dir), "app_id")


@query
def undersample_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.undersample_exact(staged_detail(spark, sf_dir), "app_id")


@query
def undersample_hash_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one rejection per approval."""
    return sampling.undersample_hash(detail(spark, sf_dir), "app_id", ratio=1.0)


@query
def undersample_exact_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.undersample_exact(staged_detail(spark, sf_dir), "app_id", ratio=1)


@query
def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.split_hash(detail(spark, sf_dir), "app_id").select("app_id", "label", "split")


@query
def split_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(detail(spark, sf_dir).select("app_id", "label"), "split-rows")
    return sampling.split_stratified(rows, "app_id")


# --- evaluation ------------------------------------------------------------------------------


@query
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_matrix(predictions(spark, sf_dir))


@query
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.classification_metrics(predictions(spark, sf_dir))


@query
def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.class_report(predictions(spark, sf_dir))


@query
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.threshold_sweep(scored_applications(spark, sf_dir))


@query
def auc_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.auc_rank(scored_applications(spark, sf_dir))


# --- feature stages and importances -----------------------------------------------------------


@query
def feature_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indices, one-hot slots, alphabetical codes and filled numbers of all rows, fitted on the training part."""
    split = stage(sampling.split_hash(detail(spark, sf_dir), "app_id"), "split")
    train = split.where("split = 'train'")
    one_hot = models.one_hot_features(models.RAW_ONLY).fit(train)
    ordinal = models.ordinal_features(models.FeatureSet(("purpose",), ("dti",))).fit(train).transform(split)
    slots = one_hot.transform(split).withColumns({"_purpose": vector_to_array("purpose_vec"), "_all": vector_to_array("features")})
    return slots.selectExpr(
        "app_id",
        *(f"CAST({c}_idx AS int) AS {c}_idx" for c in models.RAW_ONLY.categorical),
        "CAST(array_position(_purpose, 1.0D) AS int) - 1 AS purpose_slot",
        "element_at(_all, -3) AS loan_amnt", "element_at(_all, -2) AS emp_length", "element_at(_all, -1) AS dti",
    ).join(ordinal.selectExpr("app_id", "CAST(purpose_code AS int) AS purpose_code"), "app_id")


@query
def importance_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranking and running sum, as for a model's importances, of the applications per purpose."""
    counts = summaries.purpose_stats(detail(spark, sf_dir))
    return models.rank_importance(counts.selectExpr("purpose AS feature", "CAST(total_cnt AS double) AS importance"), 10)


# --- models (no SQL form: iterative) -----------------------------------------------------------


def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.leak_safe_rows(staged_detail(spark, sf_dir), "app_id")


@query
def model_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-only models of a planted signal, missing numbers included: what must hold of every fit.

    A label is 1 where dti is below 20, a tenth of them flipped by key.
    """
    low = "CAST(coalesce(dti, 0) < 20 AS int)"
    planted = detail(spark, sf_dir).withColumn("label", F.expr(f"CASE WHEN app_id % 10 = 0 THEN 1 - {low} ELSE {low} END"))
    split = stage(sampling.split_hash(planted, "app_id"), "split")
    train, test = (split.where(f"split = '{part}'").drop("split") for part in ("train", "test"))
    fitted = models.fit_all(train, models.one_hot_features(models.RAW_ONLY), models.standard_classifiers())
    folder = stage_folder(spark, "models")
    n_train, n_test = train.count(), test.count()
    rows = []
    for name, model in fitted.items():
        loaded = models.load_model(models.save_model(model, folder))
        scored = stage(model.score(test).select("app_id", "label", "prob_1"), f"scored-{name}")
        again = loaded.score(test).selectExpr("app_id AS again_id", "prob_1 AS again")
        same = scored.join(again, F.expr("app_id = again_id AND prob_1 = again"), "left_semi")
        explain = models.linear_importance if name == "LogisticRegression" else models.tree_importance
        top = [r["feature"] for r in explain(spark, loaded).collect()]
        rows.append(
            evaluate.auc_rank(scored).selectExpr(f"'{name}' AS model", "auc_roc > 0.6 AS auc_ok")
            .withColumn("same_rows", same.agg(F.count("*")).scalar())
            .withColumn("n_slots", F.lit(len(loaded.feature_names)))
            .withColumn("explained", F.lit(bool(top) and set(top) <= set(loaded.feature_names)))
        )
    return reduce(DataFrame.unionByName, rows).selectExpr("*", f"{n_train}L AS train_rows", f"{n_test}L AS test_rows")


@query
def boosting_patience(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosting with an area-based stop on the planted signal of ``model_contract``: what must hold in each round.

    The area of every round is computed again from the emitted margins, by ranks; the kept model's own margins must
    be those of its best round.
    """
    low = "CAST(coalesce(dti, 0) < 20 AS int)"
    planted = detail(spark, sf_dir).withColumn("label", F.expr(f"CASE WHEN app_id % 10 = 0 THEN 1 - {low} ELSE {low} END"))
    flagged = stage(sampling.validation_flag(planted, "app_id"), "flagged")
    run = models.boost_with_patience(flagged, models.one_hot_features(models.RAW_ONLY), rounds=12, patience=12, keep=["app_id"], maxDepth=3)
    # Rows of a round with the same margin share one rank, the mean of their places; only distinct margins are sorted.
    place = "sum(n) OVER (PARTITION BY round ORDER BY prob_1) - (n - 1) / 2.0D"
    by_ranks = (
        run.margins.groupBy("round", "prob_1").agg(F.count("*").alias("n"), F.expr("count_if(label = 1) AS pos"))
        .selectExpr("round", "n", "pos", f"pos * ({place}) AS places").groupBy("round")
        .agg(F.sum("n").alias("n_rows"), F.sum("pos").alias("n_pos"), F.sum("places").alias("places"))
        .selectExpr("*", "(places - n_pos * (n_pos + 1) / 2.0D) / (CAST(n_pos AS double) * (n_rows - n_pos)) AS area")
    )
    told = spark.createDataFrame([(i, a, i <= run.best_round, max(run.areas[:i]) <= run.areas[run.best_round - 1]) for i, a in enumerate(run.areas, 1)],
                                 "round int, told double, kept boolean, best_so_far boolean")
    final = run.fitted.pipeline.transform(flagged.where("is_validation")).select("app_id", vector_to_array("rawPrediction")[1].alias("raw"))
    # Spark's raw prediction of boosted trees is the margin itself.
    same = run.margins.where(f"round = {run.best_round}").join(final, "app_id").where("abs(raw - prob_1) < 1e-9").agg(F.count("*")).scalar()
    joined = by_ranks.join(told, "round").withColumn("same_margins", same)
    return joined.selectExpr("CAST(round AS bigint) AS round", "n_rows", "n_pos", "abs(area - told) < 1e-6 AS area_agrees", "best_so_far", "same_margins")


@query
def model_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undersample, split, fit the three classifiers, compare on the test part."""
    return training.train_and_compare(model_rows(spark, sf_dir), "app_id").leaderboard


@query
def tree_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = training.train_and_compare(
        model_rows(spark, sf_dir), "app_id", classifiers={"RandomForest": models.random_forest()}
    )
    return models.tree_importance(spark, run.fitted["RandomForest"])
