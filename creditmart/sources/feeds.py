"""The two application feeds, derived from the ``orders`` and ``customer`` tables.

Both feeds are projections of ``orders JOIN customer``; every value is text, as in a raw
CSV extract, and ``app_id`` identifies the application.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart import rules
from creditmart.functions import array_of

# --- fixed values: what the derived columns pick from, by position -----------------
FEED_STATES: tuple[str | None, ...] = (*rules.VALID_STATES, "XX", "")
FEED_EMPLOYMENT: tuple[str | None, ...] = (*rules.EMPLOYMENT_YEARS, None, "n/a")
FEED_TITLES: tuple[str | None, ...] = (
    "Debt Consolidation",
    " credit_card ",
    "Credit card refinancing",
    "Home improvement",
    "small business loan",
    "New CAR",
    "Home buying",
    "major_purchase",
    "Medical expenses",
    "Moving and relocation",
    "Vacation",
    "Wedding day",
    "Solar panels",
    "Student loan",
    None,
    "misc",
)
FEED_HOME: tuple[str, ...] = ("MORTGAGE", "RENT", "OWN", "ANY", "OTHER", "NONE")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: Iterable[str | None], position: str) -> str:
    return f"element_at({array_of(values)}, CAST({position} AS int) + 1)"


_AMOUNT = "CAST(o_totalprice / 10 AS string)"
_TITLE = _pick(FEED_TITLES, "o_orderkey % 16")
_STATE = _pick(FEED_STATES, "c_custkey % 53")
_EMPLOYMENT = _pick(FEED_EMPLOYMENT, "o_orderkey % 13")
_ZIP = "concat(lpad(CAST(c_custkey % 1000 AS string), 3, '0'), 'xx')"
_PRIORITY = "CAST(substring(o_orderpriority, 1, 1) AS int)"
_GRADE = f"substring('ABCDE', {_PRIORITY}, 1)"

_REJECTED = (
    "o_orderkey AS app_id",
    f"{_AMOUNT} AS loan_amnt_raw",
    "date_format(o_orderdate, 'yyyy-MM-dd') AS application_date",
    f"{_TITLE} AS loan_title",
    "CASE WHEN o_orderkey % 5 <> 0 THEN CAST(500 + c_custkey % 350 AS string) END AS risk_score",
    "CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE concat(o_orderkey % 230 - 10, '%') END AS dti_raw",
    f"{_ZIP} AS zip_code",
    f"{_STATE} AS state",
    f"{_EMPLOYMENT} AS employment_length",
    "'0' AS policy_code",
)
_ACCEPTED = (
    "o_orderkey AS app_id",
    f"{_AMOUNT} AS loan_amnt",
    "date_format(o_orderdate, 'MMM-yyyy') AS issue_d",
    f"{_TITLE} AS purpose",
    f"{_STATE} AS addr_state",
    f"{_EMPLOYMENT} AS emp_length",
    "CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_orderkey % 120 AS string) END AS dti",
    f"{_ZIP} AS zip_code",
    f"{_GRADE} AS grade",
    f"concat({_GRADE}, 1 + o_orderkey % 5) AS sub_grade",
    f"{_pick(rules.RAW_STATUSES, '(o_orderkey + c_custkey) % 6')} AS loan_status",
    f"CAST(5 + 3 * {_PRIORITY} + o_orderkey % 4 AS string) AS int_rate",
    "CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal * 25 AS string) END AS annual_inc",
    f"{_pick(FEED_HOME, 'c_custkey % 6')} AS home_ownership",
    "CAST(580 + c_custkey % 270 AS string) AS fico_range_low",
    "CASE WHEN c_custkey % 5 < 2 THEN ' 60 months' ELSE ' 36 months' END AS term",
)


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer: the source of both feeds.

    No join hint: customer grows with the data. A hot customer is split at run time
    (adaptive skew join), since nothing downstream relies on this join's partitioning.
    """
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return orders.join(customer, F.expr("o_custkey = c_custkey"))


def _rejected(source: DataFrame) -> DataFrame:
    return source.where("o_orderstatus <> 'F'").selectExpr(*_REJECTED)


def _accepted(source: DataFrame) -> DataFrame:
    return source.where("o_orderstatus = 'F'").selectExpr(*_ACCEPTED)


def feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The rejected and the accepted feed. The status test is pushed into each scan."""
    source = applications(spark, sf_dir)
    return _rejected(source), _accepted(source)


def rejected_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rejected(applications(spark, sf_dir))


def accepted_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accepted(applications(spark, sf_dir))


def scored_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applications with a deterministic score, to check evaluation against SQL."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS app_id",
        "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label",
        "(o_orderkey * 37) % 100 / 100.0D AS prob_1",
    )
