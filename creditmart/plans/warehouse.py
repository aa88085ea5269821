"""The batch build: raw feeds -> detail -> summaries -> feature table, and the marts.

Every layer is a written table the next one reads, so a lost executor or a failed step
never restarts the chain, and each later scan touches only the columns it needs.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from creditmart import schemas
from creditmart.functions import exprs
from creditmart.operators import clean, features, marts, rollups, states, summaries
from creditmart.sources import files, publish
from creditmart.sources.stage import stage


@dataclass(frozen=True)
class ReportInputs:
    """The cleaned feeds the marts read."""

    rejected: DataFrame
    rejected_any_date: DataFrame
    accepted: DataFrame
    combined: DataFrame

    @classmethod
    def of(cls, raw_rejected: DataFrame, raw_accepted: DataFrame, staged: bool = False) -> ReportInputs:
        """``staged`` writes both cleaned feeds once; use it when several marts are built."""
        rejected_any = clean.report_rejected(raw_rejected, require_date=False)
        accepted = clean.report_accepted(raw_accepted)
        if staged:
            rejected_any = stage(rejected_any, "report-rejected")
            accepted = stage(accepted, "report-accepted")
        rejected = rejected_any.where("year IS NOT NULL")
        return cls(rejected, rejected_any, accepted, clean.report_combined(rejected, accepted))


@dataclass(frozen=True)
class Mart:
    build: Callable[[ReportInputs], DataFrame]
    # Column -> ascending, in sorting order.
    order_by: dict[str, bool]


def _by_count(key: str) -> dict[str, bool]:
    """Most rows first, the key breaking ties."""
    return {"total_cnt": False, key: True}


def _by(*keys: str) -> dict[str, bool]:
    return dict.fromkeys(keys, True)


def reporting_marts() -> dict[str, Mart]:
    """The marts with the order their rows are written in."""
    return {
        "trend_monthly": Mart(lambda i: marts.trend_monthly(i.rejected, i.accepted), _by("year", "month")),
        "approval_by_purpose": Mart(lambda i: marts.approval_by_purpose(i.combined), _by_count("purpose")),
        "approval_by_emp": Mart(lambda i: marts.approval_by_emp(i.combined), _by_count("emp_length_label")),
        "approval_by_dti": Mart(lambda i: marts.approval_by_dti(i.combined), _by_count("dti_bucket")),
        "approval_by_amnt": Mart(lambda i: marts.approval_by_amnt(i.combined), _by_count("amnt_bucket")),
        "risk_grade_status": Mart(lambda i: marts.risk_grade_status(i.accepted), _by("grade", "loan_status")),
        "risk_grade_summary": Mart(lambda i: marts.risk_grade_summary(i.accepted), _by("grade")),
        "borrower_income": Mart(lambda i: marts.borrower_income(i.accepted), _by("income_bucket")),
        "borrower_home": Mart(lambda i: marts.borrower_home(i.accepted), _by_count("home_ownership")),
        "borrower_fico": Mart(lambda i: marts.borrower_fico(i.rejected, i.accepted), _by("score_bucket")),
        "purpose_term_detail": Mart(lambda i: marts.purpose_term_detail(i.accepted), _by("purpose", "term")),
        "int_rate_trend": Mart(lambda i: marts.int_rate_trend(i.accepted), _by("year", "grade")),
        "geo_map": Mart(lambda i: marts.geo_map(i.rejected_any_date, i.accepted), _by_count("state_code")),
        "heatmap_purpose_grade": Mart(lambda i: marts.heatmap_purpose_grade(i.accepted), _by("purpose", "grade")),
        "year_risk_trend": Mart(lambda i: marts.year_risk_trend(i.accepted), _by("year")),
    }


def lookup_marts() -> dict[str, Mart]:
    """Summary tables published for rate look-ups; ``build`` reads detail rows."""
    return {
        "geo_lookup": Mart(summaries.geo_stats, _by_count("addr_state")),
        "purpose_lookup": Mart(summaries.purpose_stats, _by_count("purpose")),
        "zip_lookup": Mart(summaries.zip_stats, _by_count("zip_code")),
    }


def build_detail(raw_rejected: DataFrame, raw_accepted: DataFrame, folder: str) -> dict[str, int]:
    """Write the detail layer; returns rows per table. The union reads the written parts.

    Feeds without an ``app_id`` get a ``row_key``, so every later table has a key.
    """
    spark = raw_rejected.sparkSession
    if "app_id" not in raw_rejected.columns:
        raw_rejected, raw_accepted = files.with_row_key(raw_rejected, "r-"), files.with_row_key(raw_accepted, "a-")
    key = [next(c for c in ("app_id", "row_key") if c in raw_rejected.columns)]
    counts = {
        "rejected_clean": files.write_layer(clean.clean_rejected(raw_rejected, carry=key), f"{folder}/rejected_clean"),
        "accepted_clean": files.write_layer(clean.clean_accepted(raw_accepted, carry=key), f"{folder}/accepted_clean"),
    }
    parts = [files.read_layer(spark, f"{folder}/{name}") for name in counts]
    counts["combined"] = files.write_layer(clean.combine(*parts), f"{folder}/combined")
    return counts


def build_counted_detail(raw: DataFrame, accepted: bool, folder: str, carry: tuple[str, ...] = ()) -> dict[str, int]:
    """Write one feed's detail rows; returns ``rows, kept`` and ``dropped_<rule>`` (by the first rule failed), counted in the same pass."""
    observed = Observation()
    marked = clean.failed_rules(raw, accepted, carry).observe(observed, *exprs(clean.drop_counts()))
    clean.kept_detail(marked, accepted, carry).write.mode("overwrite").parquet(folder)
    return observed.get


def build_summaries(detail: DataFrame, folder: str) -> dict[str, int]:
    tables = {
        "geo_stats": (summaries.geo_stats, _by_count("addr_state")),
        "purpose_stats": (summaries.purpose_stats, _by_count("purpose")),
        "zip_stats": (summaries.zip_stats, _by_count("zip_code")),
        "emp_stats": (summaries.employment_stats, _by("emp_length")),
    }
    return {
        name: files.write_layer(files.sorted_by(summarise(detail), order), f"{folder}/{name}")
        for name, (summarise, order) in tables.items()
    }


def read_rates(spark: SparkSession, folder: str, names: tuple[str, str, str]) -> dict[str, DataFrame]:
    """Rate tables from written state, purpose and zip tables."""
    read = (lambda name: publish.read_published(spark, name, folder)) if names == LOOKUP_TABLES else (lambda name: files.read_layer(spark, f"{folder}/{name}"))
    return features.rates_from_summaries(*map(read, names))


SUMMARY_TABLES = ("geo_stats", "purpose_stats", "zip_stats")
LOOKUP_TABLES = ("geo_lookup", "purpose_lookup", "zip_lookup")


def build_features(detail: DataFrame, summary_folder: str, folder: str) -> int:
    """The feature table: detail rows joined with the written summaries. A row key of the detail is carried along."""
    rated = features.join_rates(detail, read_rates(detail.sparkSession, summary_folder, SUMMARY_TABLES))
    key = [c for c in ("row_key", "app_id") if c in detail.columns]
    return files.write_layer(rated.select(*key, *schemas.FEATURES.names), f"{folder}/model_input")


#: Each mart from the states of (rejected, accepted).
ROLLUPS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    **{name: getattr(rollups, name) for name in ("trend_monthly", "approval_by_purpose", "approval_by_emp", "approval_by_dti", "approval_by_amnt", "borrower_fico", "geo_map")},
    **{
        name: lambda rejected, accepted, build=getattr(rollups, name): build(accepted)
        for name in ("risk_grade_status", "risk_grade_summary", "borrower_income", "borrower_home", "purpose_term_detail", "int_rate_trend", "heatmap_purpose_grade", "year_risk_trend")
    },
}
PUBLISHERS = 4  # tables published at a time: each is a small job of its own


def feed_states(raw_rejected: DataFrame, raw_accepted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The states of both feeds: one scan each, written once."""
    rejected = states.rejected_states(clean.report_rejected(raw_rejected, require_date=False))
    return stage(rejected, "rejected-states"), stage(states.accepted_states(clean.report_accepted(raw_accepted)), "accepted-states")


def publish_marts(rejected: DataFrame, accepted: DataFrame, folder: str) -> dict[str, str]:
    """All reporting marts from the states of the feeds; returns the folder of each."""
    orders = {name: mart.order_by for name, mart in reporting_marts().items()}

    def one(name: str) -> str:
        return publish.publish_parquet(ROLLUPS[name](rejected, accepted), name, folder, orders[name])

    with ThreadPoolExecutor(PUBLISHERS) as pool:
        return dict(zip(orders, pool.map(one, orders), strict=True))


def build_marts(raw_rejected: DataFrame, raw_accepted: DataFrame, folder: str) -> dict[str, str]:
    """Publish all reporting marts; each feed is scanned once."""
    return publish_marts(*feed_states(raw_rejected, raw_accepted), folder)


def build_lookups(detail: DataFrame, folder: str) -> dict[str, str]:
    return {
        name: publish.publish_parquet(mart.build(detail), name, folder, mart.order_by)
        for name, mart in lookup_marts().items()
    }


def publish_lookups(spark: SparkSession, summary_folder: str, folder: str) -> dict[str, str]:
    """The lookups from summaries that are already written."""
    orders = (mart.order_by for mart in lookup_marts().values())
    return {
        name: publish.publish_parquet(files.read_layer(spark, f"{summary_folder}/{summary}"), name, folder, order)
        for name, summary, order in zip(LOOKUP_TABLES, SUMMARY_TABLES, orders, strict=True)
    }


def build_warehouse(raw_rejected: DataFrame, raw_accepted: DataFrame, folder: str) -> dict[str, int]:
    """All layers in order under ``folder``; returns the row counts of the written tables."""
    spark: SparkSession = raw_rejected.sparkSession
    counts = build_detail(raw_rejected, raw_accepted, f"{folder}/detail")
    detail = files.read_layer(spark, f"{folder}/detail/combined")
    counts |= build_summaries(detail, f"{folder}/summary")
    counts["model_input"] = build_features(detail, f"{folder}/summary", f"{folder}/features")
    build_marts(raw_rejected, raw_accepted, f"{folder}/marts")
    publish_lookups(spark, f"{folder}/summary", f"{folder}/marts")
    return counts
