"""Fixed values of the domain, stated once and shared by every operator.

Everything here must equal what the source data and its published reports use:
changing an entry changes results.
"""

from __future__ import annotations

# --- fixed values: US states (50 + DC), code -> name ---------------------------
STATE_NAMES: dict[str, str] = {
    "AL": "Alabama",
    "AK": "Alaska",
    "AZ": "Arizona",
    "AR": "Arkansas",
    "CA": "California",
    "CO": "Colorado",
    "CT": "Connecticut",
    "DE": "Delaware",
    "FL": "Florida",
    "GA": "Georgia",
    "HI": "Hawaii",
    "ID": "Idaho",
    "IL": "Illinois",
    "IN": "Indiana",
    "IA": "Iowa",
    "KS": "Kansas",
    "KY": "Kentucky",
    "LA": "Louisiana",
    "ME": "Maine",
    "MD": "Maryland",
    "MA": "Massachusetts",
    "MI": "Michigan",
    "MN": "Minnesota",
    "MS": "Mississippi",
    "MO": "Missouri",
    "MT": "Montana",
    "NE": "Nebraska",
    "NV": "Nevada",
    "NH": "New Hampshire",
    "NJ": "New Jersey",
    "NM": "New Mexico",
    "NY": "New York",
    "NC": "North Carolina",
    "ND": "North Dakota",
    "OH": "Ohio",
    "OK": "Oklahoma",
    "OR": "Oregon",
    "PA": "Pennsylvania",
    "RI": "Rhode Island",
    "SC": "South Carolina",
    "SD": "South Dakota",
    "TN": "Tennessee",
    "TX": "Texas",
    "UT": "Utah",
    "VT": "Vermont",
    "VA": "Virginia",
    "WA": "Washington",
    "WV": "West Virginia",
    "WI": "Wisconsin",
    "WY": "Wyoming",
    "DC": "District of Columbia",
}
VALID_STATES: tuple[str, ...] = tuple(STATE_NAMES)

# --- fixed values: employment length labels -> years ---------------------------
EMPLOYMENT_YEARS: dict[str, float] = {
    "< 1 year": 0.0,
    "1 year": 1.0,
    "2 years": 2.0,
    "3 years": 3.0,
    "4 years": 4.0,
    "5 years": 5.0,
    "6 years": 6.0,
    "7 years": 7.0,
    "8 years": 8.0,
    "9 years": 9.0,
    "10+ years": 10.0,
}

# --- fixed values: purpose rules, tried in this order on lower(trim(text)) ------
# The first rule with a needle contained in the text wins; nothing matching is "other".
PURPOSE_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("debt_consolidation", ("consolidat",)),
    ("credit_card", ("credit card", "credit_card")),
    ("home_improvement", ("home improv", "home_improv")),
    ("small_business", ("business",)),
    ("car", ("car", "auto", "vehicle")),
    ("house", ("home buy", "house", "home purchase")),
    ("major_purchase", ("major purchase", "major_purchase")),
    ("medical", ("medical", "health")),
    ("moving", ("moving", "relocation")),
    ("vacation", ("vacation", "holiday")),
    ("wedding", ("wedding", "marriage")),
    ("renewable_energy", ("renewable", "solar", "green")),
    ("educational", ("educat", "school", "student")),
)
PURPOSE_OTHER = "other"

# --- fixed values: loan status groups -----------------------------------------
STATUS_PAID = "Fully Paid"
STATUS_CURRENT = "Current"
STATUS_CHARGED_OFF = "Charged Off"
STATUS_LATE = "Late / Past Due"
DEFAULTED_STATUSES: tuple[str, ...] = ("Charged Off", "Default")
RAW_STATUSES: tuple[str, ...] = (
    "Fully Paid",
    "Current",
    "Charged Off",
    "Default",
    "Late (31-120 days)",
    "In Grace Period",
)
EXCLUDED_HOME_OWNERSHIP: tuple[str, ...] = ("ANY", "OTHER", "NONE")

# --- fixed values: report bands, [edge, edge) with an open top band -------------
DTI_BANDS = ((10, 20, 30, 40), ("0-10", "10-20", "20-30", "30-40", "40+"))
AMOUNT_BANDS = (
    (5000, 10000, 15000, 20000, 25000),
    ("<$5K", "$5-10K", "$10-15K", "$15-20K", "$20-25K", ">$25K"),
)
INCOME_BANDS = (
    (30000, 50000, 80000, 120000, 200000),
    ("<$30K", "$30-50K", "$50-80K", "$80-120K", "$120-200K", ">$200K"),
)
SCORE_BANDS = (
    (600, 650, 700, 750, 800),
    ("<600", "600-650", "650-700", "700-750", "750-800", "800+"),
)

# --- fixed values: accepted DTI ranges (both ends included) ---------------------
DETAIL_DTI_RANGE = (0, 200)
REPORT_DTI_RANGE = (0, 100)

# --- fixed values: fill-ins for features with no value --------------------------
FEATURE_DEFAULTS: dict[str, float] = {
    "state_approval_rate": 0.07,
    "state_avg_dti": 18.0,
    "purpose_approval_rate": 0.07,
    "purpose_avg_loan_amnt": 8000.0,
    "zip_approval_rate": 0.07,
    "loan_amnt": 0.0,
    "emp_length": 0.0,
    "dti": 0.0,
}

# --- fixed values: conformance patterns -----------------------------------------
PATTERN_NOT_NUMERIC = r"[^0-9.]"
PATTERN_DECIMAL = r"^[0-9.]+$"
PATTERN_INTEGER = r"^[0-9]+$"
PATTERN_MONTH_YEAR = r"^[A-Za-z]{3}-[0-9]{4}$"

# --- fixed values: what is known before / only after the decision ----------------
PRE_APPROVAL_COLUMNS: tuple[str, ...] = (
    "loan_amnt", "term", "purpose", "title", "addr_state",
    "emp_length", "emp_title", "home_ownership", "annual_inc",
    "verification_status", "dti", "earliest_cr_line", "open_acc",
    "pub_rec", "revol_bal", "revol_util", "total_acc",
    "fico_range_low", "fico_range_high", "application_type",
    "mort_acc", "pub_rec_bankruptcies", "zip_code",
)
POST_APPROVAL_COLUMNS: tuple[str, ...] = (
    "funded_amnt", "funded_amnt_inv", "int_rate", "installment",
    "grade", "sub_grade", "issue_d", "loan_status",
    "total_pymnt", "total_rec_prncp", "total_rec_int",
    "last_pymnt_d", "last_pymnt_amnt", "recoveries",
)

# --- fixed values: scoring thresholds reported ------------------------------------
REPORT_THRESHOLDS: tuple[float, ...] = (0.3, 0.4, 0.5, 0.6, 0.7)

# Share of missing values above which a column is flagged, in percent.
MISSING_ALARM_PCT = 5.0
# Upper ends of the missing-rate bands, in percent.
MISSING_BANDS = (5.0, 50.0)
