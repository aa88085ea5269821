"""Declared schemas: raw feeds, detail and feature tables, and the published tables."""

from __future__ import annotations

from pyspark.sql import types as T


def struct(**fields: str) -> T.StructType:
    """A schema from column name -> type name, without needing a session."""
    kinds = {
        "string": T.StringType(),
        "int": T.IntegerType(),
        "bigint": T.LongType(),
        "double": T.DoubleType(),
    }
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in fields.items()])


# --- fixed values: raw rejected feed, in file order; every column is text -----------
REJECTED_COLUMNS: tuple[str, ...] = (
    "loan_amnt_raw", "application_date", "loan_title", "risk_score", "dti_raw",
    "zip_code", "state", "employment_length", "policy_code",
)
# --- fixed values: columns read of the wide accepted feed ------------------------------
ACCEPTED_COLUMNS: tuple[str, ...] = (
    "loan_amnt", "issue_d", "purpose", "addr_state", "emp_length", "dti", "zip_code",
    "grade", "sub_grade", "loan_status", "int_rate", "annual_inc", "home_ownership",
    "fico_range_low", "verification_status", "term", "installment", "funded_amnt",
)

DETAIL = struct(
    loan_amnt="double", purpose="string", addr_state="string", emp_length="double",
    dti="double", zip_code="string", label="int",
)
FEATURES = struct(
    loan_amnt="double", emp_length="double", dti="double",
    state_approval_rate="double", state_avg_dti="double",
    purpose_approval_rate="double", purpose_avg_loan_amnt="double",
    zip_approval_rate="double",
    purpose="string", addr_state="string", zip_code="string", label="int",
)

_APPROVAL = {
    "total_cnt": "bigint", "acc_cnt": "bigint", "rej_cnt": "bigint",
    "approval_rate": "double", "avg_loan_amnt": "double", "avg_dti": "double",
}

# --- fixed values: published tables, columns in their declared order ------------------
PUBLISHED: dict[str, T.StructType] = {
    "trend_monthly": struct(
        year="int", month="int", year_month="string", rej_cnt="bigint", acc_cnt="bigint",
        total_cnt="bigint", approval_rate="double", avg_loan_amnt_rej="double",
        avg_loan_amnt_acc="double", avg_int_rate="double",
    ),
    "approval_by_purpose": struct(purpose="string", **_APPROVAL),
    "approval_by_emp": struct(emp_length_label="string", **_APPROVAL),
    "approval_by_dti": struct(dti_bucket="string", **_APPROVAL),
    "approval_by_amnt": struct(amnt_bucket="string", **_APPROVAL),
    "risk_grade_status": struct(
        grade="string", loan_status="string", cnt="bigint", avg_int_rate="double",
        avg_loan_amnt="double", grade_total="bigint", pct_of_grade="double",
    ),
    "risk_grade_summary": struct(
        grade="string", total_cnt="bigint", charged_off_cnt="bigint", charged_off_rate="double",
        avg_int_rate="double", avg_loan_amnt="double", avg_dti="double", avg_annual_inc="double",
    ),
    "borrower_income": struct(
        income_bucket="string", total_cnt="bigint", charged_off_cnt="bigint",
        charged_off_rate="double", avg_int_rate="double", avg_loan_amnt="double", avg_dti="double",
    ),
    "borrower_home": struct(
        home_ownership="string", total_cnt="bigint", charged_off_cnt="bigint",
        charged_off_rate="double", avg_int_rate="double", avg_loan_amnt="double",
        avg_annual_inc="double",
    ),
    "borrower_fico": struct(
        score_bucket="string", acc_cnt="bigint", charged_off_cnt="bigint",
        charged_off_rate="double", avg_int_rate="double", rej_cnt="bigint",
    ),
    "purpose_term_detail": struct(
        purpose="string", term="string", cnt="bigint", avg_loan_amnt="double",
        avg_int_rate="double", avg_dti="double", charged_off_cnt="bigint", charged_off_rate="double",
    ),
    "int_rate_trend": struct(
        year="int", grade="string", cnt="bigint", avg_int_rate="double", avg_loan_amnt="double",
        charged_off_cnt="bigint", charged_off_rate="double",
    ),
    "geo_map": struct(
        state_code="string", state_name="string", total_cnt="bigint", acc_cnt="bigint",
        rej_cnt="bigint", approval_rate="double", avg_loan_amnt="double", avg_dti="double",
        avg_int_rate="double", avg_annual_inc="double",
    ),
    "heatmap_purpose_grade": struct(
        purpose="string", grade="string", cnt="bigint", charged_off_cnt="bigint",
        charged_off_rate="double", avg_int_rate="double", avg_loan_amnt="double",
    ),
    "year_risk_trend": struct(
        year="int", total_cnt="bigint", avg_int_rate="double", avg_loan_amnt="double",
        avg_annual_inc="double", avg_dti="double", charged_off_cnt="bigint", charged_off_rate="double",
    ),
    "geo_lookup": struct(
        addr_state="string", total_cnt="bigint", approved_cnt="bigint", rejected_cnt="bigint",
        approval_rate="double", avg_loan_amnt="double", avg_dti="double", avg_emp_length="double",
        std_loan_amnt="double",
    ),
    "purpose_lookup": struct(
        purpose="string", total_cnt="bigint", approved_cnt="bigint", rejected_cnt="bigint",
        approval_rate="double", avg_loan_amnt="double", avg_dti="double", avg_emp_length="double",
    ),
    "zip_lookup": struct(
        zip_code="string", total_cnt="bigint", approved_cnt="bigint", approval_rate="double",
        avg_loan_amnt="double", avg_dti="double",
    ),
}
# --- fixed values: declared maximum text lengths -----------------------------------------
TEXT_LENGTHS: dict[str, int] = {
    "year_month": 8, "purpose": 50, "emp_length_label": 20, "dti_bucket": 10, "amnt_bucket": 10,
    "grade": 5, "loan_status": 30, "income_bucket": 15, "home_ownership": 20, "score_bucket": 10,
    "term": 20, "state_code": 5, "state_name": 50, "addr_state": 5, "zip_code": 5,
}
