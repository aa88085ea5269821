"""Raw feeds to clean detail rows: the warehouse form and the reporting form."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart import rules
from creditmart.functions import exprs
from creditmart.functions import numbers as num
from creditmart.functions import scalars as sc

SHARED_REPORT_COLUMNS = ("loan_amnt", "purpose", "addr_state", "emp_length", "dti", "label")


def with_purpose(source: str, target: str = "purpose") -> Callable[[DataFrame], DataFrame]:
    """Set ``target`` to the purpose class of a text column.

    The lower-cased text is a projection of its own: Catalyst keeps it apart because it is
    read many times, so it is computed once per row and not once per rule.
    """

    def apply(df: DataFrame) -> DataFrame:
        others = [c for c in df.columns if c != target]
        return df.selectExpr(*others, f"{sc.purpose_key(source)} AS _purpose_key").selectExpr(
            *others, f"{sc.purpose_of_key('_purpose_key')} AS {target}"
        )

    return apply


# Each cleaning is three steps: type the columns, keep the valid rows, derive the rest.
# Catalyst pushes the row test below the typing, and keeps the purpose key, which the
# derivation reads many times, as a computed column.

# --- warehouse detail ------------------------------------------------------------


#: What a row of the detail table must satisfy: name -> test over the typed columns.
DETAIL_RULES = {
    "state": sc.valid_state("addr_state"),
    "employment": sc.valid_employment("_employment"),
    "amount": "loan_amnt IS NOT NULL",
    "dti": sc.in_range("dti", *rules.DETAIL_DTI_RANGE, keep_null=True),
}


def _detail_columns(typed: DataFrame, label: int, carry: Sequence[str]) -> DataFrame:
    return typed.selectExpr(
        *carry,
        "loan_amnt",
        f"{sc.purpose_of_key('_purpose_key')} AS purpose",
        "addr_state",
        f"{sc.employment_years('_employment')} AS emp_length",
        "dti",
        "zip_code",
        f"{label} AS label",
    )


def _detail(typed: DataFrame, label: int, carry: Sequence[str]) -> DataFrame:
    return _detail_columns(typed.where(" AND ".join(DETAIL_RULES.values())), label, carry)


def _typed_rejected(raw: DataFrame, carry: Sequence[str]) -> DataFrame:
    return raw.selectExpr(
        *carry,
        f"{num.to_number('loan_amnt_raw')} AS loan_amnt",
        f"{sc.purpose_key('loan_title')} AS _purpose_key",
        "state AS addr_state",
        "employment_length AS _employment",
        f"{num.parse_percent('dti_raw')} AS dti",
        f"{sc.zip_prefix('zip_code')} AS zip_code",
    )


def _typed_accepted(raw: DataFrame, carry: Sequence[str]) -> DataFrame:
    return raw.selectExpr(
        *carry,
        f"{num.to_number('loan_amnt')} AS loan_amnt",
        f"{sc.purpose_key('purpose')} AS _purpose_key",
        "addr_state",
        "emp_length AS _employment",
        f"{num.to_number('dti')} AS dti",
        f"{sc.zip_prefix('zip_code')} AS zip_code",
    )


def clean_rejected(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Rejected applications: known state and employment, DTI missing or 0..200."""
    return _detail(_typed_rejected(raw, carry), label=0, carry=carry)


def clean_accepted(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Accepted applications under the same rules; DTI carries no percent sign here."""
    return _detail(_typed_accepted(raw, carry), label=1, carry=carry)


# --- what cleaning drops --------------------------------------------------------------

FAILED = "failed_rules"
#: Bit i of the mask is set where the i-th rule fails; a test that is NULL fails, as in a filter.
_MASK = " + ".join(f"IF(coalesce({test}, false), 0, {1 << i})" for i, test in enumerate(DETAIL_RULES.values()))


def failed_rules(raw: DataFrame, accepted: bool, carry: Sequence[str] = ()) -> DataFrame:
    """All rows of a feed, typed, with a bit mask of the detail rules they fail."""
    typed = _typed_accepted(raw, carry) if accepted else _typed_rejected(raw, carry)
    return typed.selectExpr("*", f"{_MASK} AS {FAILED}")


def drop_counts(prefix: str = "") -> list[str]:
    """Aggregates for ``observe``: rows, rows kept, and rows by the first rule they fail. The last ones add up to the first."""
    first = {name: f"{FAILED} & {(2 << i) - 1} = {1 << i}" for i, name in enumerate(DETAIL_RULES)}
    counts = {"rows": "true", "kept": f"{FAILED} = 0"} | {f"dropped_{name}": test for name, test in first.items()}
    return [f"count_if({test}) AS {prefix}{name}" for name, test in counts.items()]


def kept_detail(marked: DataFrame, accepted: bool, carry: Sequence[str] = ()) -> DataFrame:
    """The detail rows of rows marked by :func:`failed_rules`."""
    return _detail_columns(marked.where(f"{FAILED} = 0"), int(accepted), carry)


def drop_reasons(raw: DataFrame, accepted: bool) -> DataFrame:
    """Rows of a feed by the set of rules they fail: ``failed_rules, reasons, cnt``; 0 is the rows kept."""
    names = ", ".join(f"IF({FAILED} & {1 << i} > 0, '{name}', NULL)" for i, name in enumerate(DETAIL_RULES))
    return failed_rules(raw, accepted).groupBy(FAILED).agg(F.expr("count(1) AS cnt")).selectExpr(FAILED, f"concat_ws(',', {names}) AS reasons", "cnt")


def combine(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    """Bag union by column name: duplicates stay."""
    return rejected.unionByName(accepted)


# --- reporting detail --------------------------------------------------------------

_LOW, _HIGH = rules.REPORT_DTI_RANGE
_REPORTABLE = (
    f"{sc.valid_state('addr_state')} AND loan_amnt IS NOT NULL "
    f"AND {sc.in_range('dti', _LOW, _HIGH, keep_null=False)}"
)
_DATED = f"{_REPORTABLE} AND day IS NOT NULL"
_CALENDAR = ("year(day) AS year", "month(day) AS month", f"{sc.year_month('day')} AS year_month")


def report_rejected(raw: DataFrame, require_date: bool = True) -> DataFrame:
    """Rejected applications for the marts: known state, DTI present and 0..100.

    Employment is not filtered: an unknown label is NULL years. The state map counts
    applications without a readable date too, hence ``require_date``.
    """
    typed = raw.selectExpr(
        f"{num.to_number('loan_amnt_raw')} AS loan_amnt",
        f"{sc.purpose_key('loan_title')} AS _purpose_key",
        "state AS addr_state",
        f"{sc.employment_years('employment_length')} AS emp_length",
        f"{num.parse_percent('dti_raw')} AS dti",
        f"{sc.application_day('application_date')} AS day",
        f"{num.to_number('risk_score')} AS risk_score",
    )
    return typed.where(_DATED if require_date else _REPORTABLE).selectExpr(
        "loan_amnt",
        f"{sc.purpose_of_key('_purpose_key')} AS purpose",
        "addr_state",
        "emp_length",
        "dti",
        *_CALENDAR,
        "risk_score",
        "0 AS label",
    )


def report_accepted(raw: DataFrame, normalize: bool = False) -> DataFrame:
    """Accepted loans for the marts; ``purpose`` stays as given unless asked otherwise."""
    typed = raw.selectExpr(
        f"{num.to_number('loan_amnt')} AS loan_amnt",
        f"{sc.purpose_key('purpose') if normalize else 'purpose'} AS _purpose",
        "addr_state",
        f"{sc.employment_years('emp_length')} AS emp_length",
        f"{num.to_number('dti')} AS dti",
        f"{sc.issue_month('issue_d')} AS day",
        "grade",
        "sub_grade",
        f"{sc.simplify_status('loan_status')} AS loan_status",
        f"{sc.is_charged_off('loan_status')} AS is_charged_off",
        f"{num.to_number('int_rate')} AS int_rate",
        f"{num.to_number('annual_inc')} AS annual_inc",
        "home_ownership",
        f"{num.to_number('fico_range_low')} AS fico_range_low",
        "term",
    )
    derived = [c for c in typed.columns if c not in ("_purpose", "day")]
    return typed.where(_DATED).selectExpr(
        *derived,
        f"{sc.purpose_of_key('_purpose') if normalize else '_purpose'} AS purpose",
        *_CALENDAR,
        "1 AS label",
    )


def report_combined(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    return rejected.select(*SHARED_REPORT_COLUMNS).unionByName(accepted.select(*SHARED_REPORT_COLUMNS))


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str], copies: str = "n_copies") -> DataFrame:
    """One row per key, the first by ``order``, with the number of rows it stands for.

    A minimum over a struct merges on the map side, so a key with a third of all rows
    costs one row per task; a ranking window would send them all to one task.
    """
    rest = [c for c in df.columns if c not in {*keys, *order}]
    if not rest and not order:
        return df.groupBy(*keys).agg(*exprs([f"count(1) AS {copies}"]))
    first = f"min(struct({', '.join((*order, *rest))})) AS _first"
    return df.groupBy(*keys).agg(*exprs([first, f"count(1) AS {copies}"])).select(*keys, "_first.*", copies)
