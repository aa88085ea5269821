"""One DuckDB statement per registered query, over the supplied tables."""

from __future__ import annotations

from oracle.base import (
    EMPLOYMENT,
    STATE_NAMES,
    STATES,
    amount_band,
    dti_band,
    emp_label,
    income_band,
    purpose,
    rnd,
    score_band,
    status,
    with_ctes,
)

N = "CAST(count(*) AS BIGINT)"
APPROVED = "CAST(count(*) FILTER (label = 1) AS BIGINT)"
REJECTED = "CAST(count(*) FILTER (label = 0) AS BIGINT)"
RATE = rnd("count(*) FILTER (label = 1) / count(*)", 4)
CHARGED = (
    "CAST(sum(is_charged_off) AS BIGINT) AS charged_off_cnt, "
    + rnd("sum(is_charged_off) / count(*)", 4)
    + " AS charged_off_rate"
)


def avg(name: str, digits: int, alias: str | None = None) -> str:
    return f"{rnd(f'avg({name})', digits)} AS {alias or 'avg_' + name}"


AMOUNT, DTI, RATE_AVG, INCOME, EMP = (
    avg("loan_amnt", 2), avg("dti", 4), avg("int_rate", 4), avg("annual_inc", 2), avg("emp_length", 2),
)
SUMMARY = f"{N} AS total_cnt, {APPROVED} AS approved_cnt"
APPROVAL = (
    f"{N} AS total_cnt, {APPROVED} AS acc_cnt, {REJECTED} AS rej_cnt, {RATE} AS approval_rate, {AMOUNT}, {DTI}"
)


def _summaries() -> dict[str, str]:
    d = with_ctes("dwd")
    geo = (
        f"SELECT addr_state, {SUMMARY}, {REJECTED} AS rejected_cnt, {RATE} AS approval_rate, {AMOUNT}, {DTI}, {EMP}, "
        f"{rnd('stddev_samp(loan_amnt)', 2)} AS std_loan_amnt FROM dwd GROUP BY addr_state"
    )
    return {
        "dwd_rejected_clean": with_ctes("dwd_rej") + "SELECT * FROM dwd_rej",
        "dwd_accepted_clean": with_ctes("dwd_acc") + "SELECT * FROM dwd_acc",
        "dwd_combined": d + "SELECT * FROM dwd",
        "export_csv_round_trip": d + "SELECT * EXCLUDE (app_id) FROM dwd",
        "csv_rejected_clean": with_ctes("dwd_rej") + "SELECT * EXCLUDE (app_id) FROM dwd_rej",
        "csv_accepted_clean": with_ctes("dwd_acc") + "SELECT * EXCLUDE (app_id) FROM dwd_acc",
        "dws_geo": d + geo,
        "publish_conform": d + geo,
        "dws_purpose": d
        + f"SELECT purpose, {SUMMARY}, {REJECTED} AS rejected_cnt, {RATE} AS approval_rate, {AMOUNT}, {DTI}, {EMP} "
        "FROM dwd GROUP BY purpose",
        "dws_zip": d
        + f"SELECT zip_code, {SUMMARY}, {RATE} AS approval_rate, {AMOUNT}, {DTI} FROM dwd GROUP BY zip_code",
        "dws_emp": d
        + f"SELECT emp_length, {SUMMARY}, {RATE} AS approval_rate, {AMOUNT}, {DTI} FROM dwd GROUP BY emp_length",
        "label_distribution": d + f"SELECT label, {N} AS cnt FROM dwd GROUP BY label",
        "value_frequency": d + f"SELECT purpose, {N} AS cnt FROM dwd GROUP BY purpose",
        "class_balance": d
        + f"SELECT {REJECTED} AS n_rejected, {APPROVED} AS n_approved, "
        f"{rnd('count(*) FILTER (label = 0) / count(*) FILTER (label = 1)', 4)} AS imbalance_ratio FROM dwd",
        "kpi_metrics": d
        + f"SELECT {SUMMARY}, {REJECTED} AS rejected_cnt, {RATE} AS approval_rate, {AMOUNT}, {DTI}, {EMP}, "
        "count(DISTINCT addr_state) AS n_states, count(DISTINCT zip_code) AS n_zips FROM dwd",
        "state_ranking": with_ctes("dwd", extra={"geo": geo})
        + "SELECT addr_state, total_cnt, approval_rate, "
        "CAST(dense_rank() OVER (ORDER BY total_cnt DESC) AS INTEGER) AS volume_rank, "
        "CAST(dense_rank() OVER (ORDER BY approval_rate DESC) AS INTEGER) AS rate_rank FROM geo",
    }


def _mart_statements() -> dict[str, str]:
    """Bare statements over vrej / vrej_any / vacc / vall."""

    def by(label: str, name: str) -> str:
        return f"SELECT {label} AS {name}, {APPROVAL} FROM vall GROUP BY 1"

    weighted = "(coalesce({0}_rej, 0) * coalesce(rej_cnt, 0) + coalesce({0}_acc, 0) * coalesce(acc_cnt, 0)) " \
        "/ (coalesce(rej_cnt, 0) + coalesce(acc_cnt, 0))"
    total = "(coalesce(rej_cnt, 0) + coalesce(acc_cnt, 0))"
    return {
        "trend_monthly": f"""SELECT year, month, year_month, coalesce(rej_cnt, 0) AS rej_cnt,
          coalesce(acc_cnt, 0) AS acc_cnt, {total} AS total_cnt,
          {rnd(f"coalesce(acc_cnt, 0) / {total}", 4)} AS approval_rate,
          avg_loan_amnt_rej, avg_loan_amnt_acc, avg_int_rate
          FROM (SELECT year, month, year_month, {N} AS rej_cnt, {avg('loan_amnt', 2, 'avg_loan_amnt_rej')}
                FROM vrej GROUP BY ALL)
          FULL JOIN (SELECT year, month, year_month, {N} AS acc_cnt, {avg('loan_amnt', 2, 'avg_loan_amnt_acc')},
                {RATE_AVG} FROM vacc GROUP BY ALL) USING (year, month, year_month)""",
        "approval_by_purpose": by("purpose", "purpose"),
        "approval_by_emp": by(emp_label("emp_length"), "emp_length_label"),
        "approval_by_dti": by(dti_band("dti"), "dti_bucket"),
        "approval_by_amnt": by(amount_band("loan_amnt"), "amnt_bucket"),
        "risk_grade_status": f"""SELECT g.grade, loan_status, cnt, avg_int_rate, avg_loan_amnt, grade_total,
          {rnd('cnt / grade_total', 4)} AS pct_of_grade
          FROM (SELECT grade, loan_status, {N} AS cnt, {RATE_AVG}, {AMOUNT} FROM vacc
                WHERE grade IS NOT NULL GROUP BY ALL) g
          JOIN (SELECT grade, {N} AS grade_total FROM vacc WHERE grade IS NOT NULL GROUP BY ALL) t
          ON g.grade = t.grade""",
        "risk_grade_summary": f"""SELECT grade, {N} AS total_cnt, {CHARGED}, {RATE_AVG}, {AMOUNT}, {DTI}, {INCOME}
          FROM vacc WHERE grade IS NOT NULL GROUP BY grade""",
        "borrower_income": f"""SELECT {income_band('annual_inc')} AS income_bucket, {N} AS total_cnt, {CHARGED},
          {RATE_AVG}, {AMOUNT}, {DTI} FROM vacc WHERE annual_inc IS NOT NULL GROUP BY 1""",
        "borrower_home": f"""SELECT home_ownership, {N} AS total_cnt, {CHARGED}, {RATE_AVG}, {AMOUNT}, {INCOME}
          FROM vacc WHERE home_ownership IS NOT NULL AND home_ownership NOT IN ('ANY', 'OTHER', 'NONE')
          GROUP BY home_ownership""",
        "borrower_fico": f"""SELECT score_bucket, coalesce(acc_cnt, 0) AS acc_cnt,
          coalesce(charged_off_cnt, 0) AS charged_off_cnt, coalesce(charged_off_rate, 0) AS charged_off_rate,
          coalesce(avg_int_rate, 0) AS avg_int_rate, coalesce(rej_cnt, 0) AS rej_cnt
          FROM (SELECT {score_band('fico_range_low')} AS score_bucket, {N} AS acc_cnt, {CHARGED}, {RATE_AVG}
                FROM vacc WHERE fico_range_low IS NOT NULL GROUP BY 1)
          FULL JOIN (SELECT {score_band('risk_score')} AS score_bucket, {N} AS rej_cnt
                FROM vrej WHERE risk_score IS NOT NULL GROUP BY 1) USING (score_bucket)""",
        "purpose_term_detail": f"""SELECT purpose, trim(term) AS term, {N} AS cnt, {AMOUNT}, {RATE_AVG}, {DTI},
          {CHARGED} FROM vacc WHERE purpose IS NOT NULL AND term IS NOT NULL GROUP BY purpose, trim(term)""",
        "int_rate_trend": f"""SELECT year, grade, {N} AS cnt, {RATE_AVG}, {AMOUNT}, {CHARGED}
          FROM vacc WHERE grade IS NOT NULL GROUP BY year, grade""",
        "geo_map": f"""SELECT addr_state AS state_code,
          list_extract([{STATE_NAMES}], CAST(list_position([{STATES}], addr_state) AS INTEGER)) AS state_name,
          {total} AS total_cnt, coalesce(acc_cnt, 0) AS acc_cnt, coalesce(rej_cnt, 0) AS rej_cnt,
          {rnd(f"coalesce(acc_cnt, 0) / {total}", 4)} AS approval_rate,
          {rnd(weighted.format('amnt'), 2)} AS avg_loan_amnt, {rnd(weighted.format('dti'), 4)} AS avg_dti,
          coalesce(avg_int_rate, 0) AS avg_int_rate, coalesce(avg_annual_inc, 0) AS avg_annual_inc
          FROM (SELECT addr_state, {N} AS rej_cnt, {avg('loan_amnt', 2, 'amnt_rej')}, {avg('dti', 4, 'dti_rej')}
                FROM vrej_any GROUP BY addr_state)
          FULL JOIN (SELECT addr_state, {N} AS acc_cnt, {avg('loan_amnt', 2, 'amnt_acc')},
                {avg('dti', 4, 'dti_acc')}, {RATE_AVG}, {INCOME} FROM vacc GROUP BY addr_state)
          USING (addr_state)""",
        "heatmap_purpose_grade": f"""SELECT purpose, grade, {N} AS cnt, {CHARGED}, {RATE_AVG}, {AMOUNT}
          FROM vacc WHERE purpose IS NOT NULL AND grade IS NOT NULL GROUP BY purpose, grade""",
        "year_risk_trend": f"""SELECT year, {N} AS total_cnt, {RATE_AVG}, {AMOUNT}, {INCOME}, {DTI}, {CHARGED}
          FROM vacc WHERE grade IS NOT NULL GROUP BY year""",
    }


def _marts() -> dict[str, str]:
    v = with_ctes("vall")
    marts = {name: v + sql for name, sql in _mart_statements().items()}
    lookups = {"geo_lookup": "addr_state", "purpose_lookup": "purpose", "zip_lookup": "zip_code"}
    counts = [f"SELECT '{name}' AS table_name, {N} AS cnt FROM ({sql})" for name, sql in _mart_statements().items()]
    counts += [
        f"SELECT '{name}', {N} FROM (SELECT {key} FROM dwd GROUP BY {key})" for name, key in lookups.items()
    ]
    both = """SELECT addr_state, loan_amnt, dti, NULL::DOUBLE AS int_rate, NULL::DOUBLE AS annual_inc, label
      FROM vrej_any UNION ALL SELECT addr_state, loan_amnt, dti, int_rate, annual_inc, label FROM vacc"""
    return marts | {
        "mart_row_counts": with_ctes("vall", "dwd") + " UNION ALL ".join(counts),
        "geo_map_exact": with_ctes("vall", extra={"both_feeds": both})
        + f"""SELECT addr_state AS state_code,
          list_extract([{STATE_NAMES}], CAST(list_position([{STATES}], addr_state) AS INTEGER)) AS state_name,
          {N} AS total_cnt, {APPROVED} AS acc_cnt, {REJECTED} AS rej_cnt, {RATE} AS approval_rate,
          {AMOUNT}, {DTI}, {RATE_AVG}, {INCOME} FROM both_feeds GROUP BY addr_state""",
        "reject_time_rollup": v
        + f"""SELECT year, quarter, month, CAST(grouping(year, quarter, month) AS INTEGER) AS level,
          {N} AS rej_cnt, {AMOUNT}
          FROM (SELECT *, CAST(quarter(day) AS INTEGER) AS quarter FROM vrej)
          GROUP BY ROLLUP (year, quarter, month)""",
        "reject_risk": v
        + f"""SELECT {score_band('risk_score')} AS score_bucket, {N} AS rej_cnt, {DTI}, {AMOUNT}
          FROM vrej WHERE risk_score IS NOT NULL GROUP BY 1""",
        "reject_customer": v
        + f"""SELECT {emp_label('emp_length')} AS emp_length_label, {N} AS rej_cnt, {AMOUNT}, {DTI}
          FROM vrej GROUP BY 1""",
        "reject_product": v
        + f"""SELECT purpose, {amount_band('loan_amnt')} AS amnt_bucket, {N} AS rej_cnt, {AMOUNT}
          FROM vrej GROUP BY 1, 2""",
        "purpose_normalize": with_ctes("rej")
        + f"SELECT app_id, loan_title, {purpose('loan_title')} AS purpose FROM rej",
        "document_purpose": f"SELECT doc_id, {purpose('text')} AS purpose FROM documents",
        "status_simplify": with_ctes("acc")
        + f"""SELECT app_id, {status('loan_status')} AS status,
          CASE WHEN loan_status IN ('Charged Off', 'Default') THEN 1 ELSE 0 END AS is_charged_off FROM acc""",
    }


def _missing(table: str, columns: tuple[str, ...], banded: bool) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {N} AS n_rows, "
        f"CAST(count(*) FILTER ({c} IS NULL OR CAST({c} AS VARCHAR) = '') AS BIGINT) AS n_missing FROM {table}"
        for c in columns
    )
    pct = "n_missing * 100.0::DOUBLE / n_rows"
    tail = (
        f"CASE WHEN {pct} <= 5 THEN '0-5%' WHEN {pct} <= 50 THEN '5-50%' ELSE '>50%' END AS band"
        if banded
        else f"n_rows, n_missing, {pct} > 5 AS is_high"
    )
    return f"SELECT column_name, {rnd(pct, 2)} AS missing_pct, {tail} FROM ({rows})"


DETAIL_PROFILE = ("loan_amnt", "purpose", "addr_state", "emp_length", "dti", "zip_code")
REJECTED_PROFILE = (
    "loan_amnt_raw", "application_date", "loan_title", "risk_score", "dti_raw",
    "zip_code", "state", "employment_length", "policy_code",
)
ACCEPTED_PROFILE = (
    "loan_amnt", "issue_d", "purpose", "addr_state", "emp_length", "dti", "zip_code", "grade",
    "sub_grade", "loan_status", "int_rate", "annual_inc", "home_ownership", "fico_range_low", "term",
)
REJ_NUMBERS = """SELECT 'rejected' AS src, 'amount' AS field, TRY_CAST(loan_amnt_raw AS DOUBLE) AS value FROM rej
  UNION ALL SELECT 'rejected', 'dti', TRY_CAST(replace(dti_raw, '%', '') AS DOUBLE) FROM rej
  UNION ALL SELECT 'rejected', 'credit_score', TRY_CAST(risk_score AS DOUBLE) FROM rej"""
ACC_NUMBERS = """SELECT 'accepted' AS src, 'amount' AS field, TRY_CAST(loan_amnt AS DOUBLE) AS value FROM acc
  UNION ALL SELECT 'accepted', 'dti', TRY_CAST(dti AS DOUBLE) FROM acc
  UNION ALL SELECT 'accepted', 'credit_score', TRY_CAST(fico_range_low AS DOUBLE) FROM acc"""
INCOME_NUMBERS = " UNION ALL SELECT 'accepted', 'annual_inc', TRY_CAST(annual_inc AS DOUBLE) FROM acc"


def _row_key(columns: tuple[str, ...]) -> str:
    return f"concat_ws('|', {', '.join(columns)})"


def _profiles() -> dict[str, str]:
    rej, acc, both = with_ctes("rej"), with_ctes("acc"), with_ctes("rej", "acc")
    share = rnd("cnt * 100.0::DOUBLE / sum(cnt) OVER ()", 2)

    def pct(table: str, column: str) -> str:
        return (
            f"SELECT {column}, cnt, {share} AS pct FROM (SELECT {column}, {N} AS cnt FROM {table} GROUP BY ALL) "
            f"ORDER BY cnt DESC, {column} ASC NULLS FIRST LIMIT 20"
        )

    days = """SELECT 'rejected' AS src, TRY_STRPTIME(application_date, '%Y-%m-%d') AS day FROM rej
      UNION ALL SELECT 'accepted', TRY_STRPTIME(issue_d, '%b-%Y') FROM acc"""
    bad = """SELECT 'rejected.dti' AS field, dti_raw AS value FROM rej WHERE regexp_matches(dti_raw, '[^0-9.]')
      UNION ALL SELECT 'rejected.risk_score', risk_score FROM rej
        WHERE regexp_matches(risk_score, '[^0-9.]') OR risk_score IS NULL OR risk_score = ''
      UNION ALL SELECT 'accepted.fico_range_low', fico_range_low FROM acc
        WHERE NOT regexp_matches(fico_range_low, '^[0-9]+$') OR fico_range_low IS NULL OR fico_range_low = ''
      UNION ALL SELECT 'accepted.issue_d', issue_d FROM acc
        WHERE NOT regexp_matches(issue_d, '^[A-Za-z]{3}-[0-9]{4}$')"""

    def plain(text: str) -> str:
        bare = f"replace({text}, '%', '')"
        return f"CASE WHEN regexp_matches({bare}, '^[0-9.]+$') THEN TRY_CAST({bare} AS DOUBLE) END"

    comparable = f"""SELECT 'rejected' AS src, 'amount' AS field, TRY_CAST(loan_amnt_raw AS DOUBLE) AS value FROM rej
      UNION ALL SELECT 'rejected', 'dti', {plain('dti_raw')} FROM rej
      UNION ALL SELECT 'rejected', 'credit_score', {plain('risk_score')} FROM rej
      UNION ALL SELECT 'accepted', 'amount', TRY_CAST(loan_amnt AS DOUBLE) FROM acc
      UNION ALL SELECT 'accepted', 'dti', TRY_CAST(dti AS DOUBLE) FROM acc
      UNION ALL SELECT 'accepted', 'credit_score', CASE WHEN regexp_matches(fico_range_low, '^[0-9]+$') THEN TRY_CAST(fico_range_low AS DOUBLE) END FROM acc"""
    categories = ("loan_status", "grade", "sub_grade", "term", "home_ownership", "issue_d", "purpose")
    category_rows = " UNION ALL ".join(f"SELECT '{c}' AS field, {c} AS value FROM acc" for c in categories)
    numbers = ("int_rate", "loan_amnt", "annual_inc", "dti", "fico_range_low")
    number_rows = " UNION ALL ".join(
        f"SELECT '{c}' AS field, TRY_CAST({c} AS DOUBLE) AS value, {c} IS NOT NULL AND {c} <> '' AS given FROM acc"
        for c in numbers
    )
    statuses = {
        "Fully Paid": "fully_paid", "Current": "current", "Charged Off": "charged_off", "Default": "default",
        "Late (31-120 days)": "late_31_120_days", "In Grace Period": "in_grace_period",
    }
    quartiles = (
        "quantile_disc(value, 0.25) AS p25, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.75) AS p75, "
        f"{rnd('avg(value)', 2)} AS avg, CAST(count(value) AS BIGINT) AS n_valid"
    )
    label_numbers = """SELECT label, 'loan_amnt' AS field, loan_amnt AS value FROM dwd
      UNION ALL SELECT label, 'dti', dti FROM dwd"""
    fences = """SELECT src, field, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.5) AS p50,
      quantile_disc(value, 0.75) AS q3 FROM nums WHERE value IS NOT NULL GROUP BY src, field"""
    low, high = "q1 - 1.5::DOUBLE * (q3 - q1)", "q3 + 1.5::DOUBLE * (q3 - q1)"
    outside = f"count(*) FILTER (value < {low} OR value > {high})"
    return {
        "missing_rates": with_ctes("dwd") + _missing("dwd", DETAIL_PROFILE, banded=False),
        "missing_rates_rejected": rej + _missing("rej", REJECTED_PROFILE, banded=False),
        "missing_bands": acc + _missing("acc", ACCEPTED_PROFILE, banded=True),
        "pct_of_total": rej + pct("rej", "loan_title"),
        "pct_of_total_accepted": acc + pct("acc", "purpose"),
        "topk_states": rej
        + f"SELECT state, {N} AS cnt FROM rej GROUP BY state ORDER BY cnt DESC, state ASC NULLS FIRST LIMIT 10",
        "feed_volumes": both
        + f"""SELECT CAST(sum(cnt) FILTER (src = 'rejected') AS BIGINT) AS rejected_rows,
          CAST(sum(cnt) FILTER (src = 'accepted') AS BIGINT) AS accepted_rows,
          {rnd("sum(cnt) FILTER (src = 'rejected') * 100.0::DOUBLE / sum(cnt)", 2)} AS reject_rate_pct
          FROM (SELECT 'rejected' AS src, count(*) AS cnt FROM rej
                UNION ALL SELECT 'accepted', count(*) FROM acc)""",
        "feed_compare": with_ctes("rej", "acc", extra={"nums": comparable})
        + f"""SELECT src, field, {N} AS n_rows, CAST(count(value) AS BIGINT) AS n_valid, min(value) AS min_value,
          max(value) AS max_value, {rnd('avg(value)', 2)} AS avg FROM nums GROUP BY src, field""",
        "date_span": with_ctes("rej", "acc", extra={"days": days})
        + """SELECT src, strftime(min(day), '%Y-%m-%d') AS first_day, strftime(max(day), '%Y-%m-%d') AS last_day,
          CAST(count(*) FILTER (day IS NULL) AS BIGINT) AS n_unreadable FROM days GROUP BY src""",
        "year_counts": with_ctes("rej", "acc", extra={"days": days})
        + f"""SELECT src, CAST(year(day) AS INTEGER) AS yr, {N} AS cnt FROM days WHERE day IS NOT NULL
          GROUP BY 1, 2""",
        "state_compare": both
        + f"""SELECT r.state, r_cnt, {rnd('r_cnt * 100.0::DOUBLE / r_total', 1)} AS r_pct, a_cnt,
          {rnd('a_cnt * 100.0::DOUBLE / a_total', 1)} AS a_pct
          FROM (SELECT state, {N} AS r_cnt, sum(count(*)) OVER () AS r_total FROM rej GROUP BY state) r
          LEFT JOIN (SELECT addr_state AS state, {N} AS a_cnt, sum(count(*)) OVER () AS a_total
                     FROM acc GROUP BY addr_state) a USING (state)
          ORDER BY r_cnt DESC, r.state ASC NULLS FIRST LIMIT 15""",
        "nonconforming_values": with_ctes("rej", "acc", extra={"bad": bad})
        + f"""SELECT field, value, cnt, CAST(rank AS INTEGER) AS rank FROM (
          SELECT field, value, {N} AS cnt,
          row_number() OVER (PARTITION BY field ORDER BY count(*) DESC, value ASC NULLS FIRST) AS rank
          FROM bad GROUP BY field, value) WHERE rank <= 20""",
        "categorical_profile": with_ctes("acc", extra={"cats": category_rows})
        + f"""SELECT field, value, cnt, CAST(rank AS INTEGER) AS rank, n_distinct, n_given,
          {rnd('cnt * 100.0::DOUBLE / (SELECT count(*) FROM acc)', 1)} AS pct_of_rows FROM (
          SELECT field, value, {N} AS cnt, CAST(count(*) OVER (PARTITION BY field) AS BIGINT) AS n_distinct,
          CAST(sum(count(*)) OVER (PARTITION BY field) AS BIGINT) AS n_given,
          row_number() OVER (PARTITION BY field ORDER BY count(*) DESC, value) AS rank
          FROM cats WHERE value IS NOT NULL AND value <> '' GROUP BY field, value) WHERE rank <= 10""",
        "crosstab_grade_status": acc
        + "SELECT grade, "
        + ", ".join(
            f"CAST(count(*) FILTER (loan_status = '{s}') AS BIGINT) AS \"{name}\"" for s, name in statuses.items()
        )
        + " FROM acc GROUP BY grade",
        "quality_flags": both
        + f"""SELECT *, CAST(round(CAST((CAST(amount_ok AS INTEGER) + CAST(date_ok AS INTEGER)
            + CAST(dti_ok AS INTEGER) + CAST(score_ok AS INTEGER) + CAST(state_ok AS INTEGER)
            + CAST(employment_ok AS INTEGER)) / 6.0::DOUBLE AS DECIMAL(38,10)), 4) AS DOUBLE) AS quality_score
          FROM (SELECT 'rejected' AS src, app_id, coalesce(TRY_CAST(loan_amnt_raw AS DOUBLE) > 0, false) AS amount_ok,
            TRY_STRPTIME(application_date, '%Y-%m-%d') IS NOT NULL AS date_ok,
            coalesce(TRY_CAST(replace(dti_raw, '%', '') AS DOUBLE) BETWEEN 0 AND 200, false) AS dti_ok,
            TRY_CAST(risk_score AS DOUBLE) IS NOT NULL AS score_ok,
            coalesce(state IN ({STATES}), false) AS state_ok,
            coalesce(employment_length IN ('< 1 year','1 year','2 years','3 years','4 years','5 years','6 years',
              '7 years','8 years','9 years','10+ years'), false) AS employment_ok
            FROM rej
            UNION ALL SELECT 'accepted', app_id, coalesce(TRY_CAST(loan_amnt AS DOUBLE) > 0, false),
            TRY_STRPTIME(issue_d, '%b-%Y') IS NOT NULL,
            coalesce(TRY_CAST(dti AS DOUBLE) BETWEEN 0 AND 200, false), TRY_CAST(fico_range_low AS DOUBLE) IS NOT NULL,
            coalesce(addr_state IN ({STATES}), false),
            coalesce(emp_length IN ('< 1 year','1 year','2 years','3 years','4 years','5 years','6 years',
              '7 years','8 years','9 years','10+ years'), false) FROM acc)""",
        "dedupe": both
        + f"""SELECT * FROM (SELECT 'rejected' AS src, {_row_key(REJECTED_PROFILE)} AS row_key, app_id, {N} AS n_copies
          FROM (SELECT * FROM rej UNION ALL SELECT * FROM rej WHERE app_id % 7 = 0) GROUP BY ALL
          UNION ALL SELECT 'accepted', {_row_key(ACCEPTED_PROFILE)}, app_id, {N}
          FROM (SELECT * FROM acc UNION ALL SELECT * FROM acc WHERE app_id % 7 = 0) GROUP BY ALL)""",
        "quantiles_by_label": with_ctes("dwd", extra={"nums": label_numbers})
        + f"SELECT label, field, {quartiles} FROM nums GROUP BY label, field",
        "quantiles_by_feed": with_ctes("rej", "acc", extra={"nums": f"{REJ_NUMBERS} UNION ALL {ACC_NUMBERS}"})
        + f"SELECT src, field, {quartiles} FROM nums GROUP BY src, field",
        "iqr_outliers": with_ctes(
            "rej", "acc", extra={"nums": f"{REJ_NUMBERS} UNION ALL {ACC_NUMBERS} {INCOME_NUMBERS}", "fences": fences}
        )
        + f"""SELECT src, field, q1, p50, q3, {low} AS lower_bound, {high} AS upper_bound,
          CAST(count(value) AS BIGINT) AS n_valid, min(value) AS min_value, max(value) AS max_value,
          {rnd('avg(value)', 2)} AS avg, CAST({outside} AS BIGINT) AS n_outliers,
          {rnd(f'{outside} * 100.0::DOUBLE / count(value)', 2)} AS pct_outliers
          FROM nums JOIN fences USING (src, field) WHERE value IS NOT NULL GROUP BY src, field, q1, p50, q3""",
        "numeric_profile": with_ctes("acc", extra={"nums": number_rows})
        + f"""SELECT field, {rnd('count(*) FILTER (given) * 100.0::DOUBLE / count(*)', 1)} AS non_null_pct,
          {rnd('min(value)', 2)} AS min_value, {rnd('quantile_cont(value, 0.25)', 2)} AS p25,
          {rnd('quantile_cont(value, 0.5)', 2)} AS median, {rnd('quantile_cont(value, 0.75)', 2)} AS p75,
          {rnd('max(value)', 2)} AS max_value, {rnd('avg(value)', 2)} AS avg FROM nums GROUP BY field""",
        "sample_scan": rej
        + """SELECT app_id, loan_amnt_raw, dti_raw, risk_score FROM rej
          ORDER BY md5('sample-42:' || app_id) LIMIT 1000""",
    }


def _rates(source: str) -> dict[str, str]:
    return {
        "st": f"SELECT addr_state, {RATE} AS state_approval_rate, {avg('dti', 4, 'state_avg_dti')} "
        f"FROM {source} GROUP BY addr_state",
        "pu": f"SELECT purpose, {RATE} AS purpose_approval_rate, {avg('loan_amnt', 2, 'purpose_avg_loan_amnt')} "
        f"FROM {source} GROUP BY purpose",
        "zi": f"SELECT zip_code, {RATE} AS zip_approval_rate FROM {source} GROUP BY zip_code",
    }


def _features_from(rows: str) -> str:
    return f"""SELECT app_id, coalesce(loan_amnt, 0) AS loan_amnt, coalesce(emp_length, 0) AS emp_length,
      coalesce(dti, 0) AS dti, coalesce(state_approval_rate, 0.07::DOUBLE) AS state_approval_rate,
      coalesce(state_avg_dti, 18.0::DOUBLE) AS state_avg_dti,
      coalesce(purpose_approval_rate, 0.07::DOUBLE) AS purpose_approval_rate,
      coalesce(purpose_avg_loan_amnt, 8000.0::DOUBLE) AS purpose_avg_loan_amnt,
      coalesce(zip_approval_rate, 0.07::DOUBLE) AS zip_approval_rate,
      purpose, addr_state, zip_code, label
      FROM {rows} LEFT JOIN st USING (addr_state) LEFT JOIN pu USING (purpose) LEFT JOIN zi USING (zip_code)"""


def _hash(salt: str, start: int = 1, length: int = 8) -> str:
    return f"CAST('0x' || substr(md5('{salt}:' || app_id), {start}, {length}) AS BIGINT)"


def _features_and_samples() -> dict[str, str]:
    split = f"SELECT *, CASE WHEN {_hash('42')} % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM dwd"
    halves = {
        "split_rows": split,
        "train": "SELECT * FROM split_rows WHERE split = 'train'",
        "test": "SELECT * FROM split_rows WHERE split = 'test'",
    }
    describe = " UNION ALL ".join(
        f"SELECT '{c}' AS field, {N} AS n, {rnd(f'avg({c})', 6)} AS mean, {rnd(f'stddev_samp({c})', 6)} AS stddev, "
        f"min({c}) AS min_value, max({c}) AS max_value FROM feats"
        for c in ("state_approval_rate", "purpose_approval_rate")
    )
    folded = f"SELECT *, CAST({_hash('fold-42')} % 5 AS INTEGER) AS fold FROM dwd"

    def out_of_fold(key: str, name: str) -> str:
        return f"""coalesce((SELECT {rnd('sum(a) / sum(n)', 4)} FROM {name}_f f
          WHERE f.{key} = d.{key} AND f.fold <> d.fold), 0.07::DOUBLE) AS oof_{name}_approval_rate"""

    per_fold = {
        f"{name}_f": f"SELECT {key}, fold, count(*) AS n, count(*) FILTER (label = 1) AS a FROM folded GROUP BY ALL"
        for key, name in (("addr_state", "state"), ("purpose", "purpose"), ("zip_code", "zip"))
    }
    size = "SELECT count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1 FROM dwd"

    def drawn(ratio: int) -> str:
        return with_ctes("dwd", extra={"size": size}) + f"""SELECT dwd.* FROM dwd, size WHERE label = 1
          OR {_hash('under-42')} / 4294967296.0::DOUBLE < least(1.0::DOUBLE, n1 * {ratio}.0::DOUBLE / n0)"""

    def exactly(ratio: int) -> str:
        return with_ctes("dwd", extra={"size": size}) + f"""SELECT * EXCLUDE (pos, n0, n1) FROM (
          SELECT dwd.*, size.*, row_number() OVER (PARTITION BY label ORDER BY md5('under-42:' || app_id)) AS pos
          FROM dwd, size) WHERE label = 1 OR pos <= least({ratio} * n1, n0)"""

    quota = """SELECT label, n, n::DOUBLE * train_total / total AS exact, train_total,
        floor(n::DOUBLE * train_total / total) AS base FROM (
        SELECT label, count(*) AS n, sum(count(*)) OVER () AS total,
        sum(count(*)) OVER () - ceil(sum(count(*)) OVER () * 0.2::DOUBLE) AS train_total FROM dwd GROUP BY label)"""
    quotas = """SELECT label, base + CAST(row_number() OVER (ORDER BY exact - base DESC, label)
        <= train_total - sum(base) OVER () AS INTEGER) AS take FROM quota"""
    return {
        "ads_features": with_ctes("dwd", extra=_rates("dwd")) + _features_from("dwd"),
        "describe_features": with_ctes("dwd", extra=_rates("dwd") | {"feats": _features_from("dwd")}) + describe,
        "score_lookup": with_ctes("dwd", extra=halves | _rates("train")) + _features_from("test"),
        "oof_target_encode": with_ctes("dwd", extra={"folded": folded} | per_fold)
        + f"""SELECT app_id, label, fold, {out_of_fold('addr_state', 'state')},
          {out_of_fold('purpose', 'purpose')}, {out_of_fold('zip_code', 'zip')} FROM folded d""",
        "split_hash": with_ctes("dwd", extra={"split_rows": split}) + "SELECT app_id, label, split FROM split_rows",
        "undersample_hash": drawn(2),
        "undersample_hash_even": drawn(1),
        "undersample_exact": exactly(2),
        "undersample_exact_even": exactly(1),
        "split_stratified": with_ctes("dwd", extra={"quota": quota, "quotas": quotas})
        + """SELECT app_id, label, CASE WHEN pos <= take THEN 'train' ELSE 'test' END AS split FROM (
          SELECT app_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('strata-42:' || app_id)) AS pos
          FROM dwd) JOIN quotas USING (label)""",
    }


def _evaluation() -> dict[str, str]:
    pred = with_ctes("scored", extra={"preds": "SELECT *, CAST(prob_1 >= 0.5 AS INTEGER) AS prediction FROM scored"})
    classes = """SELECT c.label, count(*) FILTER (p.label = c.label AND prediction = c.label) AS hits,
      count(*) FILTER (p.label <> c.label AND prediction = c.label) AS false_hits,
      count(*) FILTER (p.label = c.label AND prediction <> c.label) AS misses
      FROM preds p, (SELECT unnest([0, 1]) AS label) c GROUP BY c.label"""
    figures = """SELECT label, hits, hits + misses AS support,
      coalesce(hits / nullif(hits + false_hits, 0), 0) AS p, coalesce(hits / nullif(hits + misses, 0), 0) AS r
      FROM classes"""
    with_f1 = "SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM figures"
    per_class = with_ctes(
        "scored",
        extra={
            "preds": "SELECT *, CAST(prob_1 >= 0.5 AS INTEGER) AS prediction FROM scored",
            "classes": classes,
            "figures": figures,
            "per_class": with_f1,
        },
    )

    def weighted(c: str) -> str:
        return rnd(f"sum({c} * support) / sum(support)", 6)

    def positive(c: str) -> str:
        return rnd(f"max({c}) FILTER (label = 1)", 6)

    counts = """SELECT threshold, CAST(count(*) FILTER (prob_1 >= threshold AND label = 1) AS BIGINT) AS tp,
      CAST(count(*) FILTER (prob_1 >= threshold AND label = 0) AS BIGINT) AS fp,
      CAST(count(*) FILTER (prob_1 < threshold AND label = 1) AS BIGINT) AS fn
      FROM scored, (SELECT unnest([0.3::DOUBLE, 0.4::DOUBLE, 0.5::DOUBLE, 0.6::DOUBLE, 0.7::DOUBLE]) AS threshold)
      GROUP BY threshold"""
    p, r = "coalesce(tp / nullif(tp + fp, 0), 0)", "coalesce(tp / nullif(tp + fn, 0), 0)"
    by_score = """SELECT prob_1, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
      FROM scored GROUP BY prob_1"""
    curve = """SELECT *, sum(pos) OVER (ORDER BY prob_1 DESC) AS tp, sum(neg) OVER (ORDER BY prob_1 DESC) AS fp,
      sum(neg) OVER (ORDER BY prob_1) - neg AS neg_below, sum(pos) OVER () AS p_all, sum(neg) OVER () AS n_all
      FROM by_score"""
    steps = """SELECT *, tp / (tp + fp) AS prec,
      coalesce(lag(tp / (tp + fp)) OVER (ORDER BY prob_1 DESC), tp / (tp + fp)) AS prec_before FROM curve"""
    return {
        "confusion_matrix": pred + f"SELECT label, prediction, {N} AS cnt FROM preds GROUP BY label, prediction",
        "classification_metrics": per_class
        + f"""SELECT CAST(sum(support) AS BIGINT) AS n, {rnd('sum(hits) / sum(support)', 6)} AS accuracy,
          {weighted('p')} AS weighted_precision, {weighted('r')} AS weighted_recall, {weighted('f')} AS weighted_f1,
          {positive('p')} AS precision_1, {positive('r')} AS recall_1, {positive('f')} AS f1_1 FROM per_class""",
        "class_report": per_class
        + f"""SELECT CASE label WHEN 1 THEN 'Accepted' ELSE 'Rejected' END AS class, {rnd('p', 6)} AS precision,
          {rnd('r', 6)} AS recall, {rnd('f', 6)} AS f1, CAST(support AS BIGINT) AS support FROM per_class
          UNION ALL SELECT 'macro avg', {rnd('avg(p)', 6)}, {rnd('avg(r)', 6)}, {rnd('avg(f)', 6)},
          CAST(sum(support) AS BIGINT) FROM per_class
          UNION ALL SELECT 'weighted avg', {weighted('p')}, {weighted('r')}, {weighted('f')},
          CAST(sum(support) AS BIGINT) FROM per_class""",
        "threshold_sweep": with_ctes("scored", extra={"counts": counts})
        + f"""SELECT threshold, tp, fp, fn, {rnd(p, 6)} AS precision, {rnd(r, 6)} AS recall,
          {rnd(f'coalesce(2 * {p} * {r} / nullif({p} + {r}, 0), 0)', 6)} AS f1 FROM counts""",
        "auc_rank": with_ctes("scored", extra={"by_score": by_score, "curve": curve, "steps": steps})
        + f"""SELECT CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
          {rnd('sum(pos::DOUBLE * (neg_below + neg / 2)) / (sum(pos)::DOUBLE * sum(neg))', 6)} AS auc_roc,
          {rnd('sum(pos / p_all * (prec + prec_before) / 2)', 6)} AS auc_pr FROM steps""",
    }


def _models() -> dict[str, str]:
    split = f"""SELECT *, CASE WHEN {_hash('42')} % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM dwd"""
    train = "SELECT * FROM split WHERE split = 'train'"
    index = ", ".join(
        f"{c}_rank AS (SELECT {c}, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS INTEGER) AS {c}_idx FROM train GROUP BY {c})"
        for c in ("purpose", "addr_state", "zip_code")
    )
    seen = {c: f"CAST((SELECT count(*) FROM {c}_rank) AS INTEGER)" for c in ("purpose", "addr_state", "zip_code")}
    indices = ", ".join(f"coalesce({c}_idx, {n}) AS {c}_idx" for c, n in seen.items())
    return {
        "feature_stages": with_ctes("dwd", extra={"split": split, "train": train})
        + f""", {index}, codes AS (SELECT purpose, CAST(row_number() OVER (ORDER BY purpose) - 1 AS INTEGER) AS code
            FROM (SELECT DISTINCT purpose FROM train))
          SELECT app_id, {indices}, coalesce(purpose_idx, {seen['purpose']}) AS purpose_slot,
          coalesce(code, {seen['purpose']}) AS purpose_code, loan_amnt, coalesce(emp_length, 0) AS emp_length, coalesce(dti, 0) AS dti
          FROM split LEFT JOIN purpose_rank USING (purpose) LEFT JOIN addr_state_rank USING (addr_state)
          LEFT JOIN zip_code_rank USING (zip_code) LEFT JOIN codes USING (purpose)""",
        "importance_ranking": with_ctes("dwd")
        + """SELECT feature, importance, CAST(rank AS INTEGER) AS rank, cumulative FROM (
          SELECT purpose AS feature, CAST(count(*) AS DOUBLE) AS importance,
          row_number() OVER (ORDER BY count(*) DESC, purpose) AS rank,
          CAST(sum(count(*)) OVER (ORDER BY count(*) DESC, purpose ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cumulative
          FROM dwd GROUP BY purpose) WHERE rank <= 10""",
        "model_contract": with_ctes("dwd", extra={"split": split, "train": train})
        + """SELECT model, true AS auc_ok, (SELECT count(*) FROM split WHERE split = 'test') AS same_rows,
          (SELECT CAST(count(DISTINCT purpose) + count(DISTINCT addr_state) + count(DISTINCT zip_code) + 6 AS INTEGER) FROM train) AS n_slots,
          true AS explained, (SELECT count(*) FROM train) AS train_rows, (SELECT count(*) FROM split WHERE split = 'test') AS test_rows
          FROM (VALUES ('LogisticRegression'), ('RandomForest'), ('GBT')) AS m(model)""",
        "boosting_patience": with_ctes("dwd")
        + f"""SELECT round, n_rows, n_pos, true AS area_agrees, true AS best_so_far, n_rows AS same_margins FROM (
          SELECT {N} AS n_rows, {APPROVED} AS n_pos FROM (
            SELECT CASE WHEN app_id % 10 = 0 THEN 1 - low ELSE low END AS label FROM (
              SELECT app_id, CASE WHEN coalesce(dti, 0) < 20 THEN 1 ELSE 0 END AS low FROM dwd WHERE {_hash('valid-42')} / 4294967296.0 < 0.2)))
          CROSS JOIN (SELECT CAST(r AS BIGINT) AS round FROM generate_series(1, 12) AS t(r))""",
    }


_GEO_COLUMNS = (
    ("addr_state", "string", True, 5, None), ("total_cnt", "bigint", False, None, 19), ("approved_cnt", "bigint", False, None, 19),
    ("rejected_cnt", "bigint", False, None, 19), ("approval_rate", "double", True, None, 15), ("avg_loan_amnt", "double", True, None, 15),
    ("avg_dti", "double", True, None, 15), ("avg_emp_length", "double", True, None, 15), ("std_loan_amnt", "double", True, None, 15),
)


def _files_and_drops() -> dict[str, str]:
    geo = _summaries()["publish_conform"]
    report = []
    for i, (name, kind, nullable, length, precision) in enumerate(_GEO_COLUMNS, 1):
        number = kind != "string"
        figures = [f"CAST({f}({name}) AS DOUBLE)" if number else "CAST(NULL AS DOUBLE)" for f in ("min", "max")]
        report.append(
            f"SELECT CAST({i} AS INTEGER) AS position, '{name}' AS column_name, '{kind}' AS data_type, {nullable} AS is_nullable, "
            f"CAST({length or 'NULL'} AS INTEGER) AS max_length, CAST({precision or 'NULL'} AS INTEGER) AS numeric_precision, {N} AS n_rows, "
            f"CAST(count(*) FILTER ({name} IS NULL) AS BIGINT) AS n_null, CAST({'NULL' if number else f'max(length({name}))'} AS INTEGER) AS longest, "
            f"{figures[0]} AS lowest, {figures[1]} AS highest FROM geo"
        )
    tests = {
        "state": "{state} IN (" + STATES + ")",
        "employment": "{employment} IN (" + EMPLOYMENT + ")",
        "amount": "TRY_CAST({amount} AS DOUBLE) IS NOT NULL",
        "dti": "TRY_CAST({dti} AS DOUBLE) IS NULL OR TRY_CAST({dti} AS DOUBLE) BETWEEN 0 AND 200",
    }
    columns = {
        "rejected": ("rej", {"state": "state", "employment": "employment_length", "amount": "loan_amnt_raw", "dti": "replace(dti_raw, '%', '')"}),
        "accepted": ("acc", {"state": "addr_state", "employment": "emp_length", "amount": "loan_amnt", "dti": "dti"}),
    }
    marked = " UNION ALL ".join(
        f"SELECT '{src}' AS src, " + ", ".join(f"NOT coalesce({test.format(**names)}, false) AS bad_{rule}" for rule, test in tests.items()) + f" FROM {feed}"
        for src, (feed, names) in columns.items()
    )
    mask = " + ".join(f"CASE WHEN bad_{rule} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(tests))
    reasons = ", ".join(f"CASE WHEN bad_{rule} THEN '{rule}' END" for rule in tests)
    ok = "NOT (" + " OR ".join(f"bad_{rule}" for rule in tests) + ")"
    figures, passed = {"rows": "true", "kept": ok, "written": ok}, "true"
    for rule in tests:
        figures[f"dropped_{rule}"] = f"{passed} AND bad_{rule}"
        passed += f" AND NOT bad_{rule}"
    accounting = " UNION ALL ".join(f"SELECT src, '{name}' AS figure, CAST(count(*) FILTER ({test}) AS BIGINT) AS cnt FROM marked GROUP BY src" for name, test in figures.items())
    both = with_ctes("rej", "acc", extra={"marked": marked})
    names = REJECTED_PROFILE
    ordered = ("loan_amnt_raw", "application_date", "loan_title", "risk_score", "dti_raw", "zip_code", "state", "employment_length", "policy_code")
    assert set(ordered) == set(names)
    quoted = {c: f"'\"' || coalesce({c}, '') || '\"'" for c in ordered}
    line = " || ',' || ".join(quoted.values())
    return {
        "schema_report": _with_geo(geo) + " UNION ALL ".join(report),
        "drop_reasons": both + f"SELECT src, CAST({mask} AS INTEGER) AS failed_rules, concat_ws(',', {reasons}) AS reasons, {N} AS cnt FROM marked GROUP BY ALL",
        "drop_accounting": both + accounting,
        "csv_quarantine": with_ctes("rej")
        + f"""SELECT {', '.join(f"CASE WHEN reason IS NULL THEN nullif({c}, '') END AS {c}" for c in ordered)}, line, reason, {N.replace('count(*)', 'count(*) OVER ()')} AS lines FROM (
          SELECT *, CASE app_id % 40 WHEN 3 THEN app_id || ',"open,' || {quoted['loan_title']} WHEN 7 THEN {line} || ',' || app_id
              WHEN 11 THEN app_id || ',' || {quoted['application_date']} END AS line,
            CASE app_id % 40 WHEN 3 THEN 'open quote' WHEN 7 THEN 'too many fields' WHEN 11 THEN 'too few fields' END AS reason FROM rej)""",
    }


def _with_geo(geo: str) -> str:
    """The summary by state as a named expression after those it rests on."""
    start = geo.rindex("SELECT addr_state,")
    return f"{geo[:start].rstrip()}, geo AS ({geo[start:]}) "


def _states() -> dict[str, str]:
    """What is made of mergeable states equals what is made of the rows."""
    direct = _summaries() | _marts()
    same = {f"rollup_{name}": direct[name] for name in _mart_statements()} | {
        "rollup_reject_time": direct["reject_time_rollup"],
        "rollup_reject_risk": direct["reject_risk"],
        "rollup_reject_customer": direct["reject_customer"],
        "rollup_reject_product": direct["reject_product"],
        "rollup_dws_geo": direct["dws_geo"],
        "rollup_dws_purpose": direct["dws_purpose"],
        "rollup_dws_zip": direct["dws_zip"],
        "rollup_dws_emp": direct["dws_emp"],
        "rollup_kpi": direct["kpi_metrics"],
        "refresh_months": direct["trend_monthly"],
    }
    sums = ", ".join(f"CAST(sum(CAST({m} AS DECIMAL(38, 9))) AS VARCHAR) AS {m}_sum" for m in ("loan_amnt", "dti", "int_rate", "annual_inc"))
    exact = f"SELECT addr_state, {N} AS cnt, {sums}, CAST(count(annual_inc) AS BIGINT) AS annual_inc_n FROM vacc GROUP BY addr_state"
    return same | {"exact_sums": with_ctes("vacc") + exact}


def oracle_sql() -> dict[str, str]:
    return _states() | _files_and_drops() | _summaries() | _marts() | _profiles() | _features_and_samples() | _evaluation() | _models()
