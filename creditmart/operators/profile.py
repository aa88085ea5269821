"""Data profiling: missing values, frequencies, distributions, feed comparisons.

Wide profiles are one aggregation with a column per figure, unfolded to rows at the end,
so a table is read once however many columns are profiled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmart import rules, schemas
from creditmart.functions import exprs, field_rows, quote, rows_of
from creditmart.functions import numbers as num
from creditmart.functions import scalars as sc
from creditmart.operators import heavy
from creditmart.operators import measures as m
from creditmart.operators import quantiles as qt
from creditmart.sources.stage import stage

_COUNT = f"{m.N} AS cnt"

# --- schema --------------------------------------------------------------------------


#: Significant decimal digits of the numeric types, as databases report them.
_PRECISION = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19, "float": 7, "double": 15}


def schema_report(df: DataFrame, text_lengths: dict[str, int] | None = None) -> DataFrame:
    """The columns as declared, beside what their rows hold: one pass, and a row for each column.

    ``max_length`` is the declared length of a text column, NULL where none is declared; ``numeric_precision`` the digits
    of a numeric column. ``n_rows, n_null`` count; ``longest`` is the longest text, ``lowest, highest`` the range of a number.
    """
    lengths = schemas.TEXT_LENGTHS if text_lengths is None else text_lengths
    measured, rows = ["count(1) AS n_rows"], []
    for i, field in enumerate(df.schema):
        kind, name = field.dataType.simpleString(), f"`{field.name}`"
        text, number = isinstance(field.dataType, T.StringType), isinstance(field.dataType, T.NumericType)
        precision = field.dataType.precision if isinstance(field.dataType, T.DecimalType) else _PRECISION.get(kind)
        measured += [
            f"count_if({name} IS NULL) AS null_{i}",
            f"{f'max(length({name}))' if text else 'CAST(NULL AS int)'} AS long_{i}",
            *(f"{f'CAST({f}({name}) AS double)' if number else 'CAST(NULL AS double)'} AS {f}_{i}" for f in ("min", "max")),
        ]
        length = lengths.get(field.name) if text else None
        rows.append({
            "position": str(i + 1), "column_name": quote(field.name), "data_type": quote(kind), "is_nullable": str(field.nullable).lower(),
            "max_length": f"CAST({'NULL' if length is None else length} AS int)", "numeric_precision": f"CAST({precision or 'NULL'} AS int)",
            "n_rows": "n_rows", "n_null": f"null_{i}", "longest": f"long_{i}", "lowest": f"min_{i}", "highest": f"max_{i}",
        })
    return df.agg(*exprs(measured)).selectExpr(rows_of(*rows))


# --- missing values --------------------------------------------------------------------


def _missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = [f"count_if({sc.is_blank(c)}) AS missing_{i}" for i, c in enumerate(columns)]
    rows = [
        {"column_name": quote(c), "n_rows": "n", "n_missing": f"missing_{i}"} for i, c in enumerate(columns)
    ]
    return (
        df.agg(*exprs([f"{m.N} AS n", *counts]))
        .selectExpr(rows_of(*rows))
        .selectExpr("*", "try_divide(n_missing * 100.0D, n_rows) AS _pct")
    )


def missing_rates(df: DataFrame, columns: Sequence[str], alarm_pct: float = rules.MISSING_ALARM_PCT) -> DataFrame:
    """NULL-or-empty share of every column in percent, flagged above ``alarm_pct``."""
    return _missing_counts(df, columns).selectExpr(
        "column_name",
        "n_rows",
        "n_missing",
        f"{num.round_half_up('_pct', 2)} AS missing_pct",
        f"coalesce(_pct > {alarm_pct}D, false) AS is_high",
    )


def missing_bands(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns graded by missing rate: fit for use, to be assessed, to be dropped."""
    low, high = rules.MISSING_BANDS
    return _missing_counts(df, columns).selectExpr(
        "column_name",
        f"{num.round_half_up('_pct', 2)} AS missing_pct",
        f"CASE WHEN _pct <= {low}D THEN '0-5%' WHEN _pct <= {high}D THEN '5-50%' "
        f"WHEN _pct > {high}D THEN '>50%' END AS band",
    )


# --- frequencies ---------------------------------------------------------------------------


def value_frequency(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.expr(_COUNT))


def top_k(df: DataFrame, by: str, key: str, k: int) -> DataFrame:
    """The ``k`` rows with the largest ``by``, ties by ``key``: k rows per task are kept."""
    return df.orderBy(F.desc(by), F.asc_nulls_first(key)).limit(k)


def pct_of_total(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values with their share of all rows in percent.

    Only values that can be among them are counted one by one (``operators.heavy``): free text has too many.
    """
    values = stage(df.select(column), "values")
    return heavy.top_k_values(values, column, k).selectExpr(column, "cnt", f"{num.percent('cnt', 'total')} AS pct")


def top_values(values: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent values per field of ``(field, value)`` rows.

    Counting merges on the map side. The rank limit is applied per task before the
    shuffle by field (Spark plans a partial group limit for it), so a field with very many
    distinct values sends ``k`` rows per task and not all of them.
    """
    return _ranked(values.groupBy("field", "value").agg(F.expr(_COUNT)), k)


def _ranked(counts: DataFrame, k: int) -> DataFrame:
    place = "row_number() OVER (PARTITION BY field ORDER BY cnt DESC, value ASC NULLS FIRST)"
    return counts.selectExpr("*", f"{place} AS rank").where(f"rank <= {k}")


def nonconforming_values(values: DataFrame, k: int = 20) -> DataFrame:
    """The most frequent offending values per field.

    ``values`` has ``(field, value, is_bad)``; a NULL ``is_bad`` is not counted as bad.
    """
    return top_values(values.where("is_bad").select("field", "value"), k)


def _checked(name: str, value: str, is_bad: str) -> dict[str, str]:
    return {"field": quote(name), "value": value, "is_bad": is_bad}


def rejected_conformance(raw: DataFrame) -> DataFrame:
    odd_dti = sc.conforms("dti_raw", rules.PATTERN_NOT_NUMERIC)
    odd_score = sc.conforms("risk_score", rules.PATTERN_NOT_NUMERIC)
    return raw.selectExpr(
        rows_of(
            _checked("rejected.dti", "dti_raw", odd_dti),
            _checked("rejected.risk_score", "risk_score", f"{odd_score} OR {sc.is_blank('risk_score')}"),
        )
    )


def accepted_conformance(raw: DataFrame) -> DataFrame:
    plain_score = sc.conforms("fico_range_low", rules.PATTERN_INTEGER)
    plain_month = sc.conforms("issue_d", rules.PATTERN_MONTH_YEAR)
    return raw.selectExpr(
        rows_of(
            _checked(
                "accepted.fico_range_low",
                "fico_range_low",
                f"NOT {plain_score} OR {sc.is_blank('fico_range_low')}",
            ),
            _checked("accepted.issue_d", "issue_d", f"NOT {plain_month}"),
        )
    )


def categorical_profile(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """Top values per column with their share of all rows, the column's distinct count and
    the number of rows with a value.

    Blank values are not ranked but count as rows. Everything follows from one count per
    (field, value): the per-field totals use the same figures, so Spark reuses the shuffle
    and the table is read once.
    """
    fields = df.selectExpr(field_rows({c: f"CAST({c} AS string)" for c in columns}))
    # Whether a value is given is an output of the count: a filter on the key itself would
    # be pushed below it and make the two readers of the count differ.
    given = f"bool_and(NOT {sc.is_blank('value')}) AS is_given"
    counts = fields.groupBy("field", "value").agg(*exprs([_COUNT, given]))
    totals = counts.groupBy("field").agg(
        *exprs(
            [
                "count_if(is_given) AS n_distinct",
                "coalesce(sum(cnt) FILTER (WHERE is_given), 0) AS n_given",
                "sum(cnt) AS _n",
            ]
        )
    )
    return (
        _ranked(counts.where("is_given"), k)
        .join(F.broadcast(totals), on="field")  # one row per column
        .selectExpr(
            "field", "value", "cnt", "rank", "n_distinct", "n_given", f"{num.percent('cnt', '_n', 1)} AS pct_of_rows"
        )
    )


def crosstab(df: DataFrame, row: str, column: str, values: dict[str, str]) -> DataFrame:
    """Counts of ``row`` by the listed values of ``column``, one output column per value.

    The list (value -> output name) is given, so no extra job finds it.
    """
    cells = (f"count_if({column} = {quote(value)}) AS {name}" for value, name in values.items())
    return df.groupBy(row).agg(*exprs(cells))


# --- distributions --------------------------------------------------------------------------


def quantiles_by_label(detail: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, mean and valid count of each column, per class."""
    values = detail.selectExpr("label", field_rows({c: c for c in columns}))
    return distribution(values, ["label", "field"])


def distribution(values: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Exact p25 / p50 / p75 with mean and count, over rows ``(*groups, value)``."""
    quartiles = qt.exact_quantiles(values, groups, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    basics = values.groupBy(*groups).agg(
        *exprs([f"{num.mean('value', 2)} AS avg", "count(value) AS n_valid"])
    )
    return basics.join(F.broadcast(quartiles), on=list(groups), how="left")


def rejected_numbers(raw: DataFrame) -> DataFrame:
    """``(src, field, value)`` of the numeric fields, percent signs stripped."""
    fields = {
        "amount": num.to_number("loan_amnt_raw"),
        "dti": num.parse_percent("dti_raw"),
        "credit_score": num.to_number("risk_score"),
    }
    return raw.selectExpr("'rejected' AS src", field_rows(fields))


def accepted_numbers(raw: DataFrame, income: bool = False) -> DataFrame:
    fields = {
        "amount": num.to_number("loan_amnt"),
        "dti": num.to_number("dti"),
        "credit_score": num.to_number("fico_range_low"),
    }
    if income:
        fields["annual_inc"] = num.to_number("annual_inc")
    return raw.selectExpr("'accepted' AS src", field_rows(fields))


def iqr_outliers(values: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Range, quartiles, 1.5 IQR fences and the share of values outside them.

    The fences come from every row, not a sample, and reach the counting pass as a
    broadcast of one row per group.
    """
    numeric = values.where("value IS NOT NULL")
    fences = qt.exact_quantiles(numeric, groups, "value", {"q1": 0.25, "p50": 0.5, "q3": 0.75}).selectExpr(
        "*", "q1 - 1.5D * (q3 - q1) AS lower_bound", "q3 + 1.5D * (q3 - q1) AS upper_bound"
    )
    return (
        numeric.join(F.broadcast(fences), on=list(groups))
        .groupBy(*groups, "q1", "p50", "q3", "lower_bound", "upper_bound")
        .agg(
            *exprs(
                [
                    "count(value) AS n_valid",
                    "min(value) AS min_value",
                    "max(value) AS max_value",
                    f"{num.mean('value', 2)} AS avg",
                    "count_if(value < lower_bound OR value > upper_bound) AS n_outliers",
                ]
            )
        )
        .selectExpr("*", f"{num.percent('n_outliers', 'n_valid')} AS pct_outliers")
    )


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, interpolated quartiles, maximum, mean and non-blank share per field."""
    values = df.selectExpr(
        rows_of(
            *(
                {"field": quote(c), "value": num.to_number(c), "is_given": f"NOT {sc.is_blank(c)}"}
                for c in columns
            )
        )
    )
    quartiles = qt.exact_quantiles(
        values, ["field"], "value", {"p25": 0.25, "median": 0.5, "p75": 0.75}, interpolate=True
    )
    basics = values.groupBy("field").agg(
        *exprs(
            [
                f"{num.percent('count_if(is_given)', m.N, 1)} AS non_null_pct",
                f"{num.round_half_up('min(value)', 2)} AS min_value",
                f"{num.round_half_up('max(value)', 2)} AS max_value",
                f"{num.mean('value', 2)} AS avg",
            ]
        )
    )
    return basics.join(F.broadcast(quartiles), on="field", how="left").selectExpr(
        "field",
        "non_null_pct",
        "min_value",
        *(f"{num.round_half_up(q, 2)} AS {q}" for q in ("p25", "median", "p75")),
        "max_value",
        "avg",
    )


def describe(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Typed count / mean / stddev / min / max per column, in one pass."""

    def figures(c: str) -> dict[str, str]:
        return {
            "n": f"count({c})",
            "mean": num.mean(c, digits),
            "stddev": num.round_half_up(f"stddev_samp({c})", digits),
            "min_value": f"min({c})",
            "max_value": f"max({c})",
        }

    wide = [f"{text} AS {c}__{name}" for c in columns for name, text in figures(c).items()]
    rows = [{"field": quote(c)} | {name: f"{c}__{name}" for name in figures(c)} for c in columns]
    return df.agg(*exprs(wide)).selectExpr(rows_of(*rows))


# --- feed against feed -----------------------------------------------------------------------


def feed_volumes(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    """Rows per feed and the overall reject rate, in one row."""
    volumes = rejected.agg(*exprs(["'rejected' AS src", _COUNT])).unionByName(
        accepted.agg(*exprs(["'accepted' AS src", _COUNT]))
    )
    rej, acc = (f"sum(CASE WHEN src = '{src}' THEN cnt ELSE 0 END)" for src in ("rejected", "accepted"))
    return volumes.agg(
        *exprs(
            [
                f"{rej} AS rejected_rows",
                f"{acc} AS accepted_rows",
                f"{num.percent(rej, 'sum(cnt)')} AS reject_rate_pct",
            ]
        )
    )


def feed_compare(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    """Range, mean and counts of comparable fields, feed by feed.

    Only plain non-negative numbers count as valid for the text fields of rejected
    applications; a trailing percent sign is accepted. The accepted score must be whole digits.
    """

    def plain(text: str) -> str:
        bare = f"replace({text}, '%', '')"
        return f"CASE WHEN {sc.conforms(bare, rules.PATTERN_DECIMAL)} THEN {num.to_number(bare)} END"

    rej = {"amount": num.to_number("loan_amnt_raw"), "dti": plain("dti_raw"), "credit_score": plain("risk_score")}
    acc = {
        "amount": num.to_number("loan_amnt"),
        "dti": num.to_number("dti"),
        "credit_score": f"CASE WHEN {sc.conforms('fico_range_low', rules.PATTERN_INTEGER)} THEN {num.to_number('fico_range_low')} END",
    }
    both = rejected.selectExpr("'rejected' AS src", field_rows(rej)).unionByName(
        accepted.selectExpr("'accepted' AS src", field_rows(acc))
    )
    return both.groupBy("src", "field").agg(
        *exprs(
            [
                f"{m.N} AS n_rows",
                "count(value) AS n_valid",
                "min(value) AS min_value",
                "max(value) AS max_value",
                f"{num.mean('value', 2)} AS avg",
            ]
        )
    )


def _feed_days(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    return rejected.selectExpr(
        "'rejected' AS src", f"{sc.application_day('application_date')} AS day"
    ).unionByName(accepted.selectExpr("'accepted' AS src", f"{sc.issue_month('issue_d')} AS day"))


def date_span(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    return (
        _feed_days(rejected, accepted)
        .groupBy("src")
        .agg(
            *exprs(
                [
                    "CAST(min(day) AS string) AS first_day",
                    "CAST(max(day) AS string) AS last_day",
                    "count_if(day IS NULL) AS n_unreadable",
                ]
            )
        )
    )


def year_counts(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    days = _feed_days(rejected, accepted).where("day IS NOT NULL")
    return days.groupBy("src", F.expr("year(day) AS yr")).agg(F.expr(_COUNT))


def state_compare(rejected: DataFrame, accepted: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` states with most rejections, with each feed's count and share.

    Both sides are aggregated first; the shares divide by scalar-subquery totals.
    """
    rej = rejected.groupBy("state").agg(F.expr("count(1) AS r_cnt"))
    acc = accepted.groupBy(F.expr("addr_state AS state")).agg(F.expr("count(1) AS a_cnt"))
    totals = {
        "_r_total": rej.agg(F.sum("r_cnt")).scalar(),
        "_a_total": acc.agg(F.sum("a_cnt")).scalar(),
    }
    return (
        top_k(rej.join(acc, on="state", how="left"), "r_cnt", "state", k)
        .withColumns(totals)
        .selectExpr(
            "state",
            "r_cnt",
            f"{num.percent('r_cnt', '_r_total', 1)} AS r_pct",
            "a_cnt",
            f"{num.percent('a_cnt', '_a_total', 1)} AS a_pct",
        )
    )


def state_ranking(geo: DataFrame) -> DataFrame:
    """States ranked by volume and by approval rate; ``geo`` has one row per valid state."""
    return geo.selectExpr(
        "addr_state",
        "total_cnt",
        "approval_rate",
        "dense_rank() OVER (PARTITION BY 1 ORDER BY total_cnt DESC) AS volume_rank",
        "dense_rank() OVER (PARTITION BY 1 ORDER BY approval_rate DESC) AS rate_rank",
    )


# --- row quality and reconciliation ----------------------------------------------------------


def quality_flags(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    """One flag per check on every application of both feeds, and the share of checks passed."""
    low, high = rules.DETAIL_DTI_RANGE

    def flags(raw: DataFrame, src: str, amount: str, day: str, dti: str, score: str, state: str, employment: str) -> DataFrame:
        checks = {
            "amount_ok": f"{num.to_number(amount)} > 0",
            "date_ok": f"{day} IS NOT NULL",
            "dti_ok": sc.in_range(dti, low, high, keep_null=False),
            "score_ok": f"{num.to_number(score)} IS NOT NULL",
            "state_ok": sc.valid_state(state),
            "employment_ok": sc.valid_employment(employment),
        }
        passed = " + ".join(f"CAST({name} AS int)" for name in checks)
        return raw.selectExpr(
            f"'{src}' AS src", "app_id", *(f"coalesce({test}, false) AS {name}" for name, test in checks.items())
        ).selectExpr("*", f"round(({passed}) / {len(checks)}.0D, 4) AS quality_score")

    return flags(
        rejected, "rejected", "loan_amnt_raw", sc.application_day("application_date"), num.parse_percent("dti_raw"),
        "risk_score", "state", "employment_length",
    ).unionByName(flags(
        accepted, "accepted", "loan_amnt", sc.issue_month("issue_d"), num.to_number("dti"), "fico_range_low", "addr_state", "emp_length",
    ))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, cnt)`` over many tables, to reconcile what was published."""
    parts = [df.agg(*exprs([f"{quote(name)} AS table_name", _COUNT])) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
