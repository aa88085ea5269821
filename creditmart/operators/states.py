"""Mergeable states of the feeds: one scan gives all that the summaries, marts and reports are made of.

A feed is aggregated once by several *cells*, small combinations of dimensions, with grouping sets. A row of the
result is the state of one group: its cell, its dimensions (NULL where the cell lacks them), its month for the
report feeds, counts and exact sums (``operators.exact``). A table for any coarser grouping is a sum over the
rows of one cell, so tables can be added to, months replaced, and the rest left as it is.

The states of a feed are far fewer than its rows: combinations of bands, states and months, but for purposes
as given and zip codes, whose number follows the data as that of their tables does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.functions import exprs
from creditmart.functions import scalars as sc
from creditmart.operators import exact

MONTH = "year_month"

#: Dimension -> expression over the cleaned rows.
ACCEPTED_DIMENSIONS = {
    "grade": "grade",
    "loan_status": "loan_status",
    "purpose": "purpose",
    "term": "trim(term)",
    "addr_state": "addr_state",
    "emp_length": "emp_length",
    "dti_bucket": sc.dti_band("dti"),
    "amnt_bucket": sc.amount_band("loan_amnt"),
    "income_bucket": f"CASE WHEN annual_inc IS NOT NULL THEN {sc.income_band('annual_inc')} END",
    "home_ownership": "home_ownership",
    "score_bucket": f"CASE WHEN fico_range_low IS NOT NULL THEN {sc.score_band('fico_range_low')} END",
}
ACCEPTED_CELLS = {
    "risk": ("grade", "loan_status"),
    "product": ("purpose", "grade", "term"),
    "state": ("addr_state",),
    "applicant": ("emp_length", "dti_bucket", "amnt_bucket"),
    "borrower": ("income_bucket", "home_ownership", "score_bucket"),
}
ACCEPTED_MEASURES = {"loan_amnt": "loan_amnt", "dti": "dti", "int_rate": "int_rate", "annual_inc": "annual_inc"}

REJECTED_DIMENSIONS = {
    "purpose": "purpose",
    "amnt_bucket": sc.amount_band("loan_amnt"),
    "addr_state": "addr_state",
    "emp_length": "emp_length",
    "dti_bucket": sc.dti_band("dti"),
    "score_bucket": f"CASE WHEN risk_score IS NOT NULL THEN {sc.score_band('risk_score')} END",
}
REJECTED_CELLS = {
    "product": ("purpose", "amnt_bucket"),
    "state": ("addr_state",),
    "applicant": ("emp_length", "dti_bucket"),
    "borrower": ("score_bucket",),
}
REJECTED_MEASURES = {"loan_amnt": "loan_amnt", "dti": "dti"}

DETAIL_DIMENSIONS = {c: c for c in ("label", "addr_state", "purpose", "zip_code", "emp_length")}
DETAIL_CELLS = {c: ("label", c) for c in ("addr_state", "purpose", "zip_code", "emp_length")}
DETAIL_MEASURES = {"loan_amnt": "loan_amnt", "dti": "dti", "emp_length_years": "emp_length", "loan_amnt_squared": "loan_amnt * loan_amnt"}


def _states(rows: DataFrame, dimensions: dict[str, str], cells: dict[str, tuple[str, ...]], measures: dict[str, str], counts: dict[str, str], always: list[str]) -> DataFrame:
    """``cell``, the columns of ``always``, the dimensions, ``n``, the counts and the measures' states, from one scan."""
    names = [*always, *dimensions]
    typed = rows.selectExpr(
        *(f"{always_} AS k_{always_}" for always_ in always),
        *(f"{text} AS k_{name}" for name, text in dimensions.items()),
        *(f"{text} AS m_{name}" for name, text in measures.items()),
        *(f"{text} AS c_{name}" for name, text in counts.items()),
    )
    sets = [[F.col(f"k_{c}") for c in (*always, *cell)] for cell in cells.values()]
    # The bit of a column is set in the grouping id where a set lacks it, first column first.
    ids = {cell: sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in (*always, *keys)) for cell, keys in cells.items()}
    aggregates = [
        "CAST(grouping_id() AS bigint) AS cell_id",
        "count(1) AS n",
        *(f"sum(c_{name}) AS {name}" for name in counts),
        *exact.parts({name: f"m_{name}" for name in measures}),
    ]
    grouped = rows_by_sets(typed, sets, [F.col(f"k_{c}") for c in names], exprs(aggregates))
    cell = f"CASE cell_id {' '.join(f'WHEN {i} THEN {cell!r}' for cell, i in ids.items())} END AS cell"
    return grouped.selectExpr(cell, *(f"k_{c} AS {c}" for c in names), "n", *counts, *exact.joined(list(measures)))


def rows_by_sets(rows: DataFrame, sets: list[list[Column]], columns: list[Column], aggregates: list[Column]) -> DataFrame:
    return rows.groupingSets(sets, *columns).agg(*aggregates)


def accepted_states(accepted: DataFrame) -> DataFrame:
    """States of the report form of the accepted feed, by month."""
    return _states(accepted, ACCEPTED_DIMENSIONS, ACCEPTED_CELLS, ACCEPTED_MEASURES, {"charged_off": "is_charged_off"}, [MONTH])


def rejected_states(rejected: DataFrame) -> DataFrame:
    """States of the report form of the rejected feed, by month; rows without a date have none."""
    return _states(rejected, REJECTED_DIMENSIONS, REJECTED_CELLS, REJECTED_MEASURES, {}, [MONTH])


def detail_states(detail: DataFrame) -> DataFrame:
    """States of the detail table, by label."""
    return _states(detail, DETAIL_DIMENSIONS, DETAIL_CELLS, DETAIL_MEASURES, {}, [])


def of_cell(states: DataFrame, cell: str) -> DataFrame:
    return states.where(F.col("cell") == cell)


def merge(states: DataFrame, measures: dict[str, str], counts: tuple[str, ...] = ()) -> DataFrame:
    """States of the same group, from several tables or versions, as one."""
    keys = [c for c in states.columns if c not in ("n", *counts) and not any(c == f"{m}_{part}" for m in measures for part in ("n", "sum", "far"))]
    return states.groupBy(*keys).agg(*exprs(["sum(n) AS n", *(f"sum({c}) AS {c}" for c in counts), *exact.merged(list(measures))]))
