"""Summaries, marts and rejected-only reports as sums over states (``operators.states``).

Each equals the table of the same name in ``summaries`` and ``marts``, which aggregate the rows, but reads a few
thousand states. Means come from exact sums, so they are the same to the last digit under any partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.functions import exprs
from creditmart.functions import numbers as num
from creditmart.functions import scalars as sc
from creditmart.operators import exact
from creditmart.operators.states import of_cell

_N = "sum(n)"
_COUNT, _TOTAL, _ACC, _REJ = (f"{_N} AS {name}" for name in ("cnt", "total_cnt", "acc_cnt", "rej_cnt"))
_YEAR = "CAST(substring(year_month, 1, 4) AS int) AS year"
_MONTH = "CAST(substring(year_month, 6, 2) AS int) AS month"


def _mean(column: str, digits: int, name: str | None = None) -> str:
    return f"{exact.mean(column, digits)} AS {name or f'avg_{column}'}"


_AMOUNT, _DTI, _RATE, _INCOME = _mean("loan_amnt", 2), _mean("dti", 4), _mean("int_rate", 4), _mean("annual_inc", 2)
_CHARGED = ("sum(charged_off) AS charged_off_cnt", f"{num.ratio('sum(charged_off)', _N)} AS charged_off_rate")


def _by(states: DataFrame, keys: list[str], aggregates: list[str]) -> DataFrame:
    return states.groupBy(*exprs(keys)).agg(*exprs(aggregates))


# --- marts --------------------------------------------------------------------------------


def trend_monthly(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    dated = of_cell(rejected, "state").where("year_month IS NOT NULL")
    rej = _by(dated, ["year_month"], [_REJ, _mean("loan_amnt", 2, "avg_loan_amnt_rej")])
    acc = _by(of_cell(accepted, "risk"), ["year_month"], [_ACC, _mean("loan_amnt", 2, "avg_loan_amnt_acc"), _RATE])
    return (
        rej.join(acc, on="year_month", how="outer")
        .fillna(0, subset=["rej_cnt", "acc_cnt"])
        .selectExpr(_YEAR, _MONTH, "*", "rej_cnt + acc_cnt AS total_cnt", f"{num.ratio('acc_cnt', 'rej_cnt + acc_cnt')} AS approval_rate")
    )


def _approval_by(rejected: tuple[DataFrame, str], accepted: tuple[DataFrame, str], key: str) -> DataFrame:
    """Approval by a dimension that is part of a cell of each feed; undated rejections do not count."""
    rej, acc = (
        of_cell(*side).where("year_month IS NOT NULL").selectExpr(f"{key}", "n", f"{label} AS label", *(f"{m}_{p}" for m in ("loan_amnt", "dti") for p in ("n", "sum", "far")))
        for side, label in ((rejected, 0), (accepted, 1))
    )
    acc_cnt, rej_cnt = "coalesce(sum(CASE WHEN label = 1 THEN n END), 0)", "coalesce(sum(CASE WHEN label = 0 THEN n END), 0)"
    figures = [_TOTAL, f"{acc_cnt} AS acc_cnt", f"{rej_cnt} AS rej_cnt", f"{num.ratio(acc_cnt, _N)} AS approval_rate", _AMOUNT, _DTI]
    return _by(rej.unionByName(acc), [key.split(" AS ")[-1]], figures)


def approval_by_purpose(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    return _approval_by((rejected, "product"), (accepted, "product"), "purpose")


def approval_by_emp(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    return _approval_by((rejected, "applicant"), (accepted, "applicant"), f"{sc.employment_label('emp_length')} AS emp_length_label")


def approval_by_dti(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    return _approval_by((rejected, "applicant"), (accepted, "applicant"), "dti_bucket")


def approval_by_amnt(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    return _approval_by((rejected, "product"), (accepted, "applicant"), "amnt_bucket")


def risk_grade_status(accepted: DataFrame) -> DataFrame:
    cells = _by(of_cell(accepted, "risk").where("grade IS NOT NULL"), ["grade", "loan_status"], [_COUNT, _RATE, _AMOUNT])
    shares = cells.selectExpr("*", "sum(cnt) OVER (PARTITION BY grade) AS grade_total")
    return shares.selectExpr("*", f"{num.ratio('cnt', 'grade_total')} AS pct_of_grade")


def risk_grade_summary(accepted: DataFrame) -> DataFrame:
    return _by(of_cell(accepted, "risk").where("grade IS NOT NULL"), ["grade"], [_TOTAL, *_CHARGED, _RATE, _AMOUNT, _DTI, _INCOME])


def borrower_income(accepted: DataFrame) -> DataFrame:
    known = of_cell(accepted, "borrower").where("income_bucket IS NOT NULL")
    return _by(known, ["income_bucket"], [_TOTAL, *_CHARGED, _RATE, _AMOUNT, _DTI])


def borrower_home(accepted: DataFrame) -> DataFrame:
    known = of_cell(accepted, "borrower").where(sc.owns_or_rents("home_ownership"))
    return _by(known, ["home_ownership"], [_TOTAL, *_CHARGED, _RATE, _AMOUNT, _INCOME])


def borrower_fico(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    acc = _by(of_cell(accepted, "borrower").where("score_bucket IS NOT NULL"), ["score_bucket"], [_ACC, *_CHARGED, _RATE])
    known = of_cell(rejected, "borrower").where("score_bucket IS NOT NULL AND year_month IS NOT NULL")
    return acc.join(_by(known, ["score_bucket"], [_REJ]), on="score_bucket", how="outer").fillna(0)


def purpose_term_detail(accepted: DataFrame) -> DataFrame:
    known = of_cell(accepted, "product").where("purpose IS NOT NULL AND term IS NOT NULL")
    return _by(known, ["purpose", "term"], [_COUNT, _AMOUNT, _RATE, _DTI, *_CHARGED])


def int_rate_trend(accepted: DataFrame) -> DataFrame:
    return _by(of_cell(accepted, "risk").where("grade IS NOT NULL"), [_YEAR, "grade"], [_COUNT, _RATE, _AMOUNT, *_CHARGED])


def geo_map(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    """As published: overall means weighted from the two sides' rounded means; undated rejections count."""
    rej = _by(of_cell(rejected, "state"), ["addr_state"], [_REJ, _mean("loan_amnt", 2, "amnt_rej"), _mean("dti", 4, "dti_rej")])
    acc = _by(of_cell(accepted, "state"), ["addr_state"], [_ACC, _mean("loan_amnt", 2, "amnt_acc"), _mean("dti", 4, "dti_acc"), _RATE, _INCOME])

    def weighted(name: str, digits: int) -> str:
        return num.ratio(f"{name}_rej * rej_cnt + {name}_acc * acc_cnt", "rej_cnt + acc_cnt", digits)

    return rej.join(acc, on="addr_state", how="outer").fillna(0).selectExpr(
        "addr_state AS state_code",
        f"{sc.state_name('addr_state')} AS state_name",
        "rej_cnt + acc_cnt AS total_cnt",
        "acc_cnt",
        "rej_cnt",
        f"{num.ratio('acc_cnt', 'rej_cnt + acc_cnt')} AS approval_rate",
        f"{weighted('amnt', 2)} AS avg_loan_amnt",
        f"{weighted('dti', 4)} AS avg_dti",
        "avg_int_rate",
        "avg_annual_inc",
    )


def heatmap_purpose_grade(accepted: DataFrame) -> DataFrame:
    known = of_cell(accepted, "product").where("purpose IS NOT NULL AND grade IS NOT NULL")
    return _by(known, ["purpose", "grade"], [_COUNT, *_CHARGED, _RATE, _AMOUNT])


def year_risk_trend(accepted: DataFrame) -> DataFrame:
    return _by(of_cell(accepted, "risk").where("grade IS NOT NULL"), [_YEAR], [_TOTAL, _RATE, _AMOUNT, _INCOME, _DTI, *_CHARGED])


def exact_sums(accepted: DataFrame) -> DataFrame:
    """Counts and sums of the accepted feed by state, the sums as text with all nine decimals."""
    sums = (f"CAST(sum({m}_sum) AS string) AS {m}_sum" for m in ("loan_amnt", "dti", "int_rate", "annual_inc"))
    return _by(of_cell(accepted, "state"), ["addr_state"], [_COUNT, *sums, "sum(annual_inc_n) AS annual_inc_n"])


# --- rejected-only reports ------------------------------------------------------------------


def _dated(rejected: DataFrame, cell: str) -> DataFrame:
    return of_cell(rejected, cell).where("year_month IS NOT NULL")


def reject_by_time(rejected: DataFrame) -> DataFrame:
    rows = _dated(rejected, "state").selectExpr("*", _YEAR, _MONTH).selectExpr("*", "CAST(ceil(month / 3) AS int) AS quarter")
    return rows.rollup("year", "quarter", "month").agg(*exprs(["CAST(grouping_id() AS int) AS level", _REJ, _AMOUNT]))


def reject_by_risk(rejected: DataFrame) -> DataFrame:
    return _by(_dated(rejected, "borrower").where("score_bucket IS NOT NULL"), ["score_bucket"], [_REJ, _DTI, _AMOUNT])


def reject_by_customer(rejected: DataFrame) -> DataFrame:
    return _by(_dated(rejected, "applicant"), [f"{sc.employment_label('emp_length')} AS emp_length_label"], [_REJ, _AMOUNT, _DTI])


def reject_by_product(rejected: DataFrame) -> DataFrame:
    return _by(_dated(rejected, "product"), ["purpose", "amnt_bucket"], [_REJ, _AMOUNT])


# --- warehouse summaries -----------------------------------------------------------------------

_APPROVED, _REJECTED = (f"coalesce(sum(CASE WHEN label = {label} THEN n END), 0)" for label in (1, 0))
_TOTALS = (_TOTAL, f"{_APPROVED} AS approved_cnt")
_REJECTED_CNT = f"{_REJECTED} AS rejected_cnt"
_APPROVAL = f"{num.ratio(_APPROVED, _N)} AS approval_rate"
_YEARS = _mean("emp_length_years", 2, "avg_emp_length")
_STD = f"{exact.deviation('loan_amnt', 'loan_amnt_squared', 2)} AS std_loan_amnt"


def geo_stats(detail: DataFrame) -> DataFrame:
    return _by(of_cell(detail, "addr_state"), ["addr_state"], [*_TOTALS, _REJECTED_CNT, _APPROVAL, _AMOUNT, _DTI, _YEARS, _STD])


def purpose_stats(detail: DataFrame) -> DataFrame:
    return _by(of_cell(detail, "purpose"), ["purpose"], [*_TOTALS, _REJECTED_CNT, _APPROVAL, _AMOUNT, _DTI, _YEARS])


def zip_stats(detail: DataFrame) -> DataFrame:
    return _by(of_cell(detail, "zip_code"), ["zip_code"], [*_TOTALS, _APPROVAL, _AMOUNT, _DTI])


def employment_stats(detail: DataFrame) -> DataFrame:
    return _by(of_cell(detail, "emp_length"), ["emp_length"], [*_TOTALS, _APPROVAL, _AMOUNT, _DTI])


def kpi_metrics(detail: DataFrame) -> DataFrame:
    """One row: figures from the cell of states, distinct counts from the states and zip codes that have a cell."""
    figures = of_cell(detail, "addr_state").agg(*exprs([*_TOTALS, _REJECTED_CNT, _APPROVAL, _AMOUNT, _DTI, _YEARS, "count(DISTINCT addr_state) AS n_states"]))
    zips = of_cell(detail, "zip_code").agg(F.expr("count(DISTINCT zip_code) AS n_zips"))
    return figures.withColumn("n_zips", zips.scalar())
