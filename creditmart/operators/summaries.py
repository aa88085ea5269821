"""Warehouse summaries: one row per state, purpose, zip prefix or employment length.

Each is a single partial + final hash aggregation. The map side folds a key holding a
third of all rows into one partial row per task, so no key makes a heavy reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.functions import exprs
from creditmart.functions import numbers as num
from creditmart.functions import scalars as sc
from creditmart.operators import measures as m

_TOTALS = (f"{m.N} AS total_cnt", f"{m.N_APPROVED} AS approved_cnt")
_REJECTED = f"{m.N_REJECTED} AS rejected_cnt"


def geo_stats(detail: DataFrame) -> DataFrame:
    deviation = f"{num.round_half_up('stddev_samp(loan_amnt)', 2)} AS std_loan_amnt"
    return detail.groupBy("addr_state").agg(
        *exprs(
            [*_TOTALS, _REJECTED, m.APPROVAL_RATE, m.AVG_AMOUNT, m.AVG_DTI, m.AVG_EMPLOYMENT, deviation]
        )
    )


def purpose_stats(detail: DataFrame) -> DataFrame:
    return detail.groupBy("purpose").agg(
        *exprs([*_TOTALS, _REJECTED, m.APPROVAL_RATE, m.AVG_AMOUNT, m.AVG_DTI, m.AVG_EMPLOYMENT])
    )


def zip_stats(detail: DataFrame) -> DataFrame:
    return detail.groupBy("zip_code").agg(*exprs([*_TOTALS, m.APPROVAL_RATE, m.AVG_AMOUNT, m.AVG_DTI]))


def employment_stats(detail: DataFrame) -> DataFrame:
    return detail.groupBy("emp_length").agg(*exprs([*_TOTALS, m.APPROVAL_RATE, m.AVG_AMOUNT, m.AVG_DTI]))


def kpi_metrics(detail: DataFrame) -> DataFrame:
    """One row of headline figures. Distinct counts are exact and merge on the map side."""
    distinct = ("count(DISTINCT addr_state) AS n_states", "count(DISTINCT zip_code) AS n_zips")
    return detail.agg(
        *exprs(
            [*_TOTALS, _REJECTED, m.APPROVAL_RATE, m.AVG_AMOUNT, m.AVG_DTI, m.AVG_EMPLOYMENT, *distinct]
        )
    )


# --- rejected-only summaries -------------------------------------------------------

_REJ = f"{m.N} AS rej_cnt"


def reject_by_time(rejected: DataFrame) -> DataFrame:
    """Counts and mean amount by year, quarter, month with subtotals and a grand total.

    ``level`` is 0 for a month, 1 for a quarter, 3 for a year and 7 for the grand total.
    """
    return (
        rejected.selectExpr("loan_amnt", "year", "CAST(ceil(month / 3) AS int) AS quarter", "month")
        .rollup("year", "quarter", "month")
        .agg(*exprs(["CAST(grouping_id() AS int) AS level", _REJ, m.AVG_AMOUNT]))
    )


def reject_by_risk(rejected: DataFrame) -> DataFrame:
    return (
        rejected.where("risk_score IS NOT NULL")
        .groupBy(F.expr(f"{sc.score_band('risk_score')} AS score_bucket"))
        .agg(*exprs([_REJ, m.AVG_DTI, m.AVG_AMOUNT]))
    )


def reject_by_customer(rejected: DataFrame) -> DataFrame:
    label = F.expr(f"{sc.employment_label('emp_length')} AS emp_length_label")
    return rejected.groupBy(label).agg(*exprs([_REJ, m.AVG_AMOUNT, m.AVG_DTI]))


def reject_by_product(rejected: DataFrame) -> DataFrame:
    bucket = F.expr(f"{sc.amount_band('loan_amnt')} AS amnt_bucket")
    return rejected.groupBy("purpose", bucket).agg(*exprs([_REJ, m.AVG_AMOUNT]))
