"""The fifteen reporting marts, each a function of the cleaned feeds.

Every mart aggregates before it joins, so joins see one row per group. Ordering is left
to the writer (see ``plans.warehouse``): a sort here would be a shuffle for nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.functions import exprs
from creditmart.functions import numbers as num
from creditmart.functions import scalars as sc
from creditmart.operators import measures as m

_COUNT = f"{m.N} AS cnt"
_TOTAL = f"{m.N} AS total_cnt"
_ACC = f"{m.N} AS acc_cnt"
_REJ = f"{m.N} AS rej_cnt"


# --- time and approval drivers ---------------------------------------------------


def trend_monthly(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    """Months of either feed. A side without rows has count 0 and NULL averages."""
    keys = ["year", "month", "year_month"]
    rej = rejected.groupBy(*keys).agg(*exprs([_REJ, m.average("loan_amnt", 2, "avg_loan_amnt_rej")]))
    acc = accepted.groupBy(*keys).agg(
        *exprs([_ACC, m.average("loan_amnt", 2, "avg_loan_amnt_acc"), m.AVG_RATE])
    )
    return (
        rej.join(acc, on=keys, how="outer")
        .fillna(0, subset=["rej_cnt", "acc_cnt"])
        .selectExpr(
            "*",
            "rej_cnt + acc_cnt AS total_cnt",
            f"{num.ratio('acc_cnt', 'rej_cnt + acc_cnt')} AS approval_rate",
        )
    )


def approval_by(combined: DataFrame, dimension: str, name: str) -> DataFrame:
    """Approval counts, rate and means over any expression of the combined feeds."""
    return combined.groupBy(F.expr(f"{dimension} AS {name}")).agg(
        *exprs(
            [
                _TOTAL,
                f"{m.N_APPROVED} AS acc_cnt",
                f"{m.N_REJECTED} AS rej_cnt",
                m.APPROVAL_RATE,
                m.AVG_AMOUNT,
                m.AVG_DTI,
            ]
        )
    )


def approval_by_purpose(combined: DataFrame) -> DataFrame:
    return approval_by(combined, "purpose", "purpose")


def approval_by_emp(combined: DataFrame) -> DataFrame:
    return approval_by(combined, sc.employment_label("emp_length"), "emp_length_label")


def approval_by_dti(combined: DataFrame) -> DataFrame:
    return approval_by(combined, sc.dti_band("dti"), "dti_bucket")


def approval_by_amnt(combined: DataFrame) -> DataFrame:
    return approval_by(combined, sc.amount_band("loan_amnt"), "amnt_bucket")


# --- risk and return ---------------------------------------------------------------


def risk_grade_status(accepted: DataFrame) -> DataFrame:
    """Grade by status with each cell's share of its grade.

    The grade total is a window over the aggregated cells (a handful per grade), not a
    second scan joined back.
    """
    return (
        accepted.where("grade IS NOT NULL")
        .groupBy("grade", "loan_status")
        .agg(*exprs([_COUNT, m.AVG_RATE, m.AVG_AMOUNT]))
        .selectExpr("*", "sum(cnt) OVER (PARTITION BY grade) AS grade_total")
        .selectExpr("*", f"{num.ratio('cnt', 'grade_total')} AS pct_of_grade")
    )


def risk_grade_summary(accepted: DataFrame) -> DataFrame:
    return (
        accepted.where("grade IS NOT NULL")
        .groupBy("grade")
        .agg(*exprs([_TOTAL, *m.CHARGED_OFF, m.AVG_RATE, m.AVG_AMOUNT, m.AVG_DTI, m.AVG_INCOME]))
    )


# --- borrowers -----------------------------------------------------------------------


def borrower_income(accepted: DataFrame) -> DataFrame:
    return (
        accepted.where("annual_inc IS NOT NULL")
        .groupBy(F.expr(f"{sc.income_band('annual_inc')} AS income_bucket"))
        .agg(*exprs([_TOTAL, *m.CHARGED_OFF, m.AVG_RATE, m.AVG_AMOUNT, m.AVG_DTI]))
    )


def borrower_home(accepted: DataFrame) -> DataFrame:
    return (
        accepted.where(sc.owns_or_rents("home_ownership"))
        .groupBy("home_ownership")
        .agg(*exprs([_TOTAL, *m.CHARGED_OFF, m.AVG_RATE, m.AVG_AMOUNT, m.AVG_INCOME]))
    )


def borrower_fico(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    """Score bands of both feeds; a band one feed lacks reads 0 in all its figures."""
    acc = (
        accepted.where("fico_range_low IS NOT NULL")
        .groupBy(F.expr(f"{sc.score_band('fico_range_low')} AS score_bucket"))
        .agg(*exprs([_ACC, *m.CHARGED_OFF, m.AVG_RATE]))
    )
    rej = (
        rejected.where("risk_score IS NOT NULL")
        .groupBy(F.expr(f"{sc.score_band('risk_score')} AS score_bucket"))
        .agg(F.expr(_REJ))
    )
    return acc.join(rej, on="score_bucket", how="outer").fillna(0)


# --- products ------------------------------------------------------------------------


def purpose_term_detail(accepted: DataFrame) -> DataFrame:
    return (
        accepted.where("purpose IS NOT NULL AND term IS NOT NULL")
        .groupBy("purpose", F.expr("trim(term) AS term"))
        .agg(*exprs([_COUNT, m.AVG_AMOUNT, m.AVG_RATE, m.AVG_DTI, *m.CHARGED_OFF]))
    )


def int_rate_trend(accepted: DataFrame) -> DataFrame:
    return (
        accepted.where("grade IS NOT NULL AND year IS NOT NULL")
        .groupBy("year", "grade")
        .agg(*exprs([_COUNT, m.AVG_RATE, m.AVG_AMOUNT, *m.CHARGED_OFF]))
    )


# --- state map, heat map, yearly risk --------------------------------------------------


def _state_columns(sides: DataFrame, *averages: str) -> DataFrame:
    return sides.selectExpr(
        "addr_state AS state_code",
        f"{sc.state_name('addr_state')} AS state_name",
        "rej_cnt + acc_cnt AS total_cnt",
        "acc_cnt",
        "rej_cnt",
        f"{num.ratio('acc_cnt', 'rej_cnt + acc_cnt')} AS approval_rate",
        *averages,
        "avg_int_rate",
        "avg_annual_inc",
    )


def geo_map(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    """States with both feeds side by side.

    As published, the overall means are weighted means of the two sides' already rounded
    means; :func:`geo_map_exact` is the same table without that detour.
    """
    rej = rejected.groupBy("addr_state").agg(
        *exprs([_REJ, m.average("loan_amnt", 2, "amnt_rej"), m.average("dti", 4, "dti_rej")])
    )
    acc = accepted.groupBy("addr_state").agg(
        *exprs(
            [
                _ACC,
                m.average("loan_amnt", 2, "amnt_acc"),
                m.average("dti", 4, "dti_acc"),
                m.AVG_RATE,
                m.AVG_INCOME,
            ]
        )
    )

    def weighted(name: str, digits: int) -> str:
        return num.ratio(f"{name}_rej * rej_cnt + {name}_acc * acc_cnt", "rej_cnt + acc_cnt", digits)

    return _state_columns(
        rej.join(acc, on="addr_state", how="outer").fillna(0),
        f"{weighted('amnt', 2)} AS avg_loan_amnt",
        f"{weighted('dti', 4)} AS avg_dti",
    )


def geo_map_exact(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    """The state map from one aggregation over both feeds, means taken over the rows.

    A state without accepted loans has NULL interest and income here, not 0.
    """
    columns = ["addr_state", "loan_amnt", "dti", "label"]
    both = rejected.selectExpr(
        *columns, "CAST(NULL AS double) AS int_rate", "CAST(NULL AS double) AS annual_inc"
    ).unionByName(accepted.select(*columns, "int_rate", "annual_inc"))
    sides = both.groupBy("addr_state").agg(
        *exprs(
            [
                f"{m.N_REJECTED} AS rej_cnt",
                f"{m.N_APPROVED} AS acc_cnt",
                m.AVG_AMOUNT,
                m.AVG_DTI,
                m.AVG_RATE,
                m.AVG_INCOME,
            ]
        )
    )
    return _state_columns(sides, "avg_loan_amnt", "avg_dti")


def heatmap_purpose_grade(accepted: DataFrame) -> DataFrame:
    return (
        accepted.where("purpose IS NOT NULL AND grade IS NOT NULL")
        .groupBy("purpose", "grade")
        .agg(*exprs([_COUNT, *m.CHARGED_OFF, m.AVG_RATE, m.AVG_AMOUNT]))
    )


def year_risk_trend(accepted: DataFrame) -> DataFrame:
    return (
        accepted.where("year IS NOT NULL AND grade IS NOT NULL")
        .groupBy("year")
        .agg(*exprs([_TOTAL, m.AVG_RATE, m.AVG_AMOUNT, m.AVG_INCOME, m.AVG_DTI, *m.CHARGED_OFF]))
    )
