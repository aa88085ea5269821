"""Common table expressions the oracle queries start from; the lists are fixed values, as in ``rules``."""

from __future__ import annotations

STATES = (
    "'AL','AK','AZ','AR','CA','CO','CT','DE','FL','GA','HI','ID','IL','IN','IA','KS','KY','LA','ME','MD',"
    "'MA','MI','MN','MS','MO','MT','NE','NV','NH','NJ','NM','NY','NC','ND','OH','OK','OR','PA','RI','SC',"
    "'SD','TN','TX','UT','VT','VA','WA','WV','WI','WY','DC'"
)
STATE_NAMES = (
    "'Alabama','Alaska','Arizona','Arkansas','California','Colorado','Connecticut','Delaware','Florida',"
    "'Georgia','Hawaii','Idaho','Illinois','Indiana','Iowa','Kansas','Kentucky','Louisiana','Maine',"
    "'Maryland','Massachusetts','Michigan','Minnesota','Mississippi','Missouri','Montana','Nebraska',"
    "'Nevada','New Hampshire','New Jersey','New Mexico','New York','North Carolina','North Dakota','Ohio',"
    "'Oklahoma','Oregon','Pennsylvania','Rhode Island','South Carolina','South Dakota','Tennessee','Texas',"
    "'Utah','Vermont','Virginia','Washington','West Virginia','Wisconsin','Wyoming','District of Columbia'"
)
EMPLOYMENT = (
    "'< 1 year','1 year','2 years','3 years','4 years','5 years','6 years','7 years','8 years','9 years',"
    "'10+ years'"
)
TITLES = (
    "'Debt Consolidation',' credit_card ','Credit card refinancing','Home improvement',"
    "'small business loan','New CAR','Home buying','major_purchase','Medical expenses',"
    "'Moving and relocation','Vacation','Wedding day','Solar panels','Student loan',NULL,'misc'"
)
STATUSES = "'Fully Paid','Current','Charged Off','Default','Late (31-120 days)','In Grace Period'"


def rnd(expression: str, digits: int) -> str:
    """Half-up rounding on decimals, blind to the order in which doubles were summed."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def purpose(text: str) -> str:
    """The ordered purpose rules."""

    def has(*needles: str) -> str:
        return " OR ".join(f"lower(trim({text})) LIKE '%{n}%' ESCAPE '!'" for n in needles)

    return f"""CASE
      WHEN {has('consolidat')} THEN 'debt_consolidation'
      WHEN {has('credit card', 'credit!_card')} THEN 'credit_card'
      WHEN {has('home improv', 'home!_improv')} THEN 'home_improvement'
      WHEN {has('small business', 'small!_business', 'business')} THEN 'small_business'
      WHEN {has('car', 'auto', 'vehicle')} THEN 'car'
      WHEN {has('home buy', 'house', 'home purchase')} THEN 'house'
      WHEN {has('major purchase', 'major!_purchase')} THEN 'major_purchase'
      WHEN {has('medical', 'health')} THEN 'medical'
      WHEN {has('moving', 'relocation')} THEN 'moving'
      WHEN {has('vacation', 'holiday')} THEN 'vacation'
      WHEN {has('wedding', 'marriage')} THEN 'wedding'
      WHEN {has('renewable', 'solar', 'green')} THEN 'renewable_energy'
      WHEN {has('educat', 'school', 'student')} THEN 'educational'
      ELSE 'other' END"""


def years(label: str) -> str:
    return f"CAST(NULLIF(list_position([{EMPLOYMENT}], {label}), 0) - 1 AS DOUBLE)"


def status(raw: str) -> str:
    return f"""CASE WHEN {raw} = 'Fully Paid' THEN 'Fully Paid' WHEN {raw} = 'Current' THEN 'Current'
      WHEN {raw} IN ('Charged Off','Default') THEN 'Charged Off' ELSE 'Late / Past Due' END"""


def dti_band(x: str) -> str:
    return (
        f"CASE WHEN {x} < 10 THEN '0-10' WHEN {x} < 20 THEN '10-20' WHEN {x} < 30 THEN '20-30' "
        f"WHEN {x} < 40 THEN '30-40' ELSE '40+' END"
    )


def amount_band(x: str) -> str:
    return (
        f"CASE WHEN {x} < 5000 THEN '<$5K' WHEN {x} < 10000 THEN '$5-10K' WHEN {x} < 15000 THEN '$10-15K' "
        f"WHEN {x} < 20000 THEN '$15-20K' WHEN {x} < 25000 THEN '$20-25K' ELSE '>$25K' END"
    )


def income_band(x: str) -> str:
    return (
        f"CASE WHEN {x} < 30000 THEN '<$30K' WHEN {x} < 50000 THEN '$30-50K' WHEN {x} < 80000 THEN '$50-80K' "
        f"WHEN {x} < 120000 THEN '$80-120K' WHEN {x} < 200000 THEN '$120-200K' ELSE '>$200K' END"
    )


def score_band(x: str) -> str:
    return (
        f"CASE WHEN {x} < 600 THEN '<600' WHEN {x} < 650 THEN '600-650' WHEN {x} < 700 THEN '650-700' "
        f"WHEN {x} < 750 THEN '700-750' WHEN {x} < 800 THEN '750-800' ELSE '800+' END"
    )


def emp_label(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN 'Unknown' WHEN {x} = 0 THEN '< 1 year' WHEN {x} = 10 THEN '10+ years' "
        f"ELSE CAST({x} AS INTEGER) || ' years' END"
    )


_JOIN = "FROM orders JOIN customer ON o_custkey = c_custkey"

CTES: dict[str, str] = {
    "rej": f"""SELECT o_orderkey AS app_id, CAST(o_totalprice / 10 AS VARCHAR) AS loan_amnt_raw,
      strftime(o_orderdate, '%Y-%m-%d') AS application_date,
      list_extract([{TITLES}], CAST(o_orderkey % 16 AS INTEGER) + 1) AS loan_title,
      CASE WHEN o_orderkey % 5 <> 0 THEN CAST(500 + c_custkey % 350 AS VARCHAR) END AS risk_score,
      CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 230 - 10 AS VARCHAR) || '%' END AS dti_raw,
      lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || 'xx' AS zip_code,
      list_extract([{STATES},'XX',''], CAST(c_custkey % 53 AS INTEGER) + 1) AS state,
      list_extract([{EMPLOYMENT},NULL,'n/a'], CAST(o_orderkey % 13 AS INTEGER) + 1) AS employment_length,
      '0' AS policy_code
      {_JOIN} WHERE o_orderstatus <> 'F'""",
    "acc": f"""SELECT o_orderkey AS app_id, CAST(o_totalprice / 10 AS VARCHAR) AS loan_amnt,
      strftime(o_orderdate, '%b-%Y') AS issue_d,
      list_extract([{TITLES}], CAST(o_orderkey % 16 AS INTEGER) + 1) AS purpose,
      list_extract([{STATES},'XX',''], CAST(c_custkey % 53 AS INTEGER) + 1) AS addr_state,
      list_extract([{EMPLOYMENT},NULL,'n/a'], CAST(o_orderkey % 13 AS INTEGER) + 1) AS emp_length,
      CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_orderkey % 120 AS VARCHAR) END AS dti,
      lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || 'xx' AS zip_code,
      substr('ABCDE', CAST(substr(o_orderpriority, 1, 1) AS INTEGER), 1) AS grade,
      substr('ABCDE', CAST(substr(o_orderpriority, 1, 1) AS INTEGER), 1)
        || CAST(1 + o_orderkey % 5 AS VARCHAR) AS sub_grade,
      list_extract([{STATUSES}], CAST((o_orderkey + c_custkey) % 6 AS INTEGER) + 1) AS loan_status,
      CAST(5 + 3 * CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + o_orderkey % 4 AS VARCHAR) AS int_rate,
      CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal * 25 AS VARCHAR) END AS annual_inc,
      list_extract(['MORTGAGE','RENT','OWN','ANY','OTHER','NONE'], CAST(c_custkey % 6 AS INTEGER) + 1)
        AS home_ownership,
      CAST(580 + c_custkey % 270 AS VARCHAR) AS fico_range_low,
      CASE WHEN c_custkey % 5 < 2 THEN ' 60 months' ELSE ' 36 months' END AS term
      {_JOIN} WHERE o_orderstatus = 'F'""",
    "dwd_rej": f"""SELECT app_id, TRY_CAST(loan_amnt_raw AS DOUBLE) AS loan_amnt, {purpose('loan_title')} AS purpose,
      state AS addr_state, {years('employment_length')} AS emp_length,
      TRY_CAST(replace(dti_raw, '%', '') AS DOUBLE) AS dti, substr(zip_code, 1, 3) AS zip_code, 0 AS label
      FROM rej WHERE state IN ({STATES}) AND employment_length IN ({EMPLOYMENT})
      AND (TRY_CAST(replace(dti_raw, '%', '') AS DOUBLE) IS NULL
           OR TRY_CAST(replace(dti_raw, '%', '') AS DOUBLE) BETWEEN 0 AND 200)
      AND TRY_CAST(loan_amnt_raw AS DOUBLE) IS NOT NULL""",
    "dwd_acc": f"""SELECT app_id, TRY_CAST(loan_amnt AS DOUBLE) AS loan_amnt, {purpose('purpose')} AS purpose,
      addr_state, {years('emp_length')} AS emp_length,
      TRY_CAST(dti AS DOUBLE) AS dti, substr(zip_code, 1, 3) AS zip_code, 1 AS label
      FROM acc WHERE addr_state IN ({STATES}) AND emp_length IN ({EMPLOYMENT})
      AND (TRY_CAST(dti AS DOUBLE) IS NULL OR TRY_CAST(dti AS DOUBLE) BETWEEN 0 AND 200)
      AND TRY_CAST(loan_amnt AS DOUBLE) IS NOT NULL""",
    "dwd": "SELECT * FROM dwd_rej UNION ALL BY NAME SELECT * FROM dwd_acc",
    "vrej_any": f"""SELECT TRY_CAST(loan_amnt_raw AS DOUBLE) AS loan_amnt, {purpose('loan_title')} AS purpose,
      state AS addr_state, {years('employment_length')} AS emp_length,
      TRY_CAST(replace(dti_raw, '%', '') AS DOUBLE) AS dti,
      TRY_STRPTIME(application_date, '%Y-%m-%d') AS day,
      TRY_CAST(risk_score AS DOUBLE) AS risk_score, 0 AS label
      FROM rej WHERE state IN ({STATES}) AND TRY_CAST(loan_amnt_raw AS DOUBLE) IS NOT NULL
      AND TRY_CAST(replace(dti_raw, '%', '') AS DOUBLE) BETWEEN 0 AND 100""",
    "vrej": """SELECT *, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
      strftime(day, '%Y-%m') AS year_month FROM vrej_any WHERE day IS NOT NULL""",
    "vacc": f"""SELECT *, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
      strftime(day, '%Y-%m') AS year_month FROM (
      SELECT TRY_CAST(loan_amnt AS DOUBLE) AS loan_amnt, purpose, addr_state,
      {years('emp_length')} AS emp_length, TRY_CAST(dti AS DOUBLE) AS dti,
      TRY_STRPTIME(issue_d, '%b-%Y') AS day, grade, sub_grade, {status('loan_status')} AS loan_status,
      CASE WHEN loan_status IN ('Charged Off', 'Default') THEN 1 ELSE 0 END AS is_charged_off,
      TRY_CAST(int_rate AS DOUBLE) AS int_rate, TRY_CAST(annual_inc AS DOUBLE) AS annual_inc,
      home_ownership, TRY_CAST(fico_range_low AS DOUBLE) AS fico_range_low, term, 1 AS label
      FROM acc WHERE addr_state IN ({STATES}) AND TRY_CAST(loan_amnt AS DOUBLE) IS NOT NULL
      AND TRY_CAST(dti AS DOUBLE) BETWEEN 0 AND 100) WHERE day IS NOT NULL""",
    "vall": """SELECT loan_amnt, purpose, addr_state, emp_length, dti, label FROM vrej
      UNION ALL SELECT loan_amnt, purpose, addr_state, emp_length, dti, label FROM vacc""",
    "scored": """SELECT o_orderkey AS app_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
      ((o_orderkey * 37) % 100) / 100.0::DOUBLE AS prob_1 FROM orders""",
}
NEEDS: dict[str, tuple[str, ...]] = {
    "dwd_rej": ("rej",),
    "dwd_acc": ("acc",),
    "dwd": ("dwd_rej", "dwd_acc"),
    "vrej_any": ("rej",),
    "vrej": ("vrej_any",),
    "vacc": ("acc",),
    "vall": ("vrej", "vacc"),
}


def with_ctes(*names: str, extra: dict[str, str] | None = None) -> str:
    """A WITH clause holding the named expressions and all they rest on."""
    extra = extra or {}
    order: list[str] = []

    def visit(name: str) -> None:
        for need in NEEDS.get(name, ()):
            visit(need)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    clauses = [f"{n} AS ({CTES[n]})" for n in order] + [f"{n} AS ({s})" for n, s in extra.items()]
    return "WITH " + ",\n".join(clauses) + "\n"
