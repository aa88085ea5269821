"""Edge tables of the column expressions."""

from __future__ import annotations

import pytest

from creditmart import rules
from creditmart.functions import numbers as num
from creditmart.functions import scalars as sc
from creditmart.operators.clean import with_purpose


def evaluate(spark, expression: str, values: list, kind: str = "string") -> list:
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[1] for r in df.selectExpr("i", f"{expression} AS y").orderBy("i").collect()]


def test_parse_percent(spark):
    texts = ["10%", "100.00%", "-1%", "12.5", "n/a", "", None, "%"]
    assert evaluate(spark, num.parse_percent("x"), texts) == [10.0, 100.0, -1.0, 12.5, None, None, None, None]


@pytest.mark.parametrize(
    ("text", "purpose"),
    [
        ("Debt Consolidation", "debt_consolidation"),
        (" credit_card ", "credit_card"),
        ("Card payoff", "car"),
        ("Healthcare", "car"),
        ("medical care", "car"),
        ("greenhouse", "house"),
        ("Business car", "small_business"),
        ("green roof", "renewable_energy"),
        ("Student loan", "educational"),
        ("consolidate credit card", "debt_consolidation"),
        ("", "other"),
        (None, "other"),
    ],
)
def test_purpose_rules_are_ordered(spark, text, purpose):
    assert evaluate(spark, sc.normalize_purpose("x"), [text]) == [purpose]
    df = spark.createDataFrame([(text,)], "title string")
    assert df.transform(with_purpose("title")).first()["purpose"] == purpose


def test_employment_years_and_labels(spark):
    labels = ["< 1 year", "1 year", "10+ years", "  1 year", "n/a", "", None]
    assert evaluate(spark, sc.employment_years("x"), labels) == [0.0, 1.0, 10.0, None, None, None, None]
    valid = evaluate(spark, f"coalesce({sc.valid_employment('x')}, false)", labels)
    assert valid == [True, True, True, False, False, False, False]
    years = [0.0, 1.0, 9.0, 10.0, None]
    assert evaluate(spark, sc.employment_label("x"), years, "double") == [
        "< 1 year", "1 years", "9 years", "10+ years", "Unknown",
    ]


def test_states(spark):
    assert len(rules.VALID_STATES) == 51
    assert evaluate(spark, f"coalesce({sc.valid_state('x')}, false)", ["CA", "DC", "ca", "XX", "", None]) == [
        True, True, False, False, False, False,
    ]
    assert evaluate(spark, sc.state_name("x"), ["DC", "XX", None]) == ["District of Columbia", None, None]


def test_bands_are_half_open_and_null_goes_up(spark):
    assert evaluate(spark, sc.dti_band("x"), [9.99, 10.0, 20.0, 30.0, 39.9, 40.0, None], "double") == [
        "0-10", "10-20", "20-30", "30-40", "30-40", "40+", "40+",
    ]
    assert evaluate(spark, sc.amount_band("x"), [4999.99, 5000.0, 24999.0, 25000.0, None], "double") == [
        "<$5K", "$5-10K", "$20-25K", ">$25K", ">$25K",
    ]
    assert evaluate(spark, sc.income_band("x"), [29999.0, 30000.0, 200000.0], "double") == [
        "<$30K", "$30-50K", ">$200K",
    ]
    assert evaluate(spark, sc.score_band("x"), [599.0, 600.0, 799.0, 800.0], "double") == [
        "<600", "600-650", "750-800", "800+",
    ]


def test_status_classes(spark):
    statuses = ["Fully Paid", "Current", "Charged Off", "Default", "In Grace Period", None]
    assert evaluate(spark, sc.simplify_status("x"), statuses) == [
        "Fully Paid", "Current", "Charged Off", "Charged Off", "Late / Past Due", "Late / Past Due",
    ]
    assert evaluate(spark, sc.is_charged_off("x"), statuses) == [0, 0, 1, 1, 0, 0]


def test_bad_dates_are_null_not_errors(spark):
    texts = ["2015-03-01", "2015-13-01", "2015-02-30", "bad", "", None]
    days = evaluate(spark, sc.application_day("x"), texts)
    assert [d and d.isoformat() for d in days] == ["2015-03-01", None, None, None, None, None]
    months = evaluate(spark, sc.issue_month("x"), ["Dec-2015", "2015-12", None])
    assert [d and d.isoformat() for d in months] == ["2015-12-01", None, None]
    assert evaluate(spark, sc.year_month("CAST(x AS date)"), ["2015-03-09", None]) == ["2015-03", None]


def test_short_cut_dates_equal_the_formatter(spark):
    def as_text(expression, values):
        return evaluate(spark, f"CAST({expression} AS string)", values)

    days = ["2015-03-01", "2015-3-1", "0000-01-01", "0001-01-01", " 2015-01-01", "2015-01-01T00", "12015-01-01",
            "2016-02-29", "2015-02-29", "2015-00-10", "2015/01/01", "", None]
    assert as_text(sc.application_day("x"), days) == as_text("try_to_date(x, 'yyyy-MM-dd')", days)
    names = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
    months = [f"{m}-2015" for m in names] + ["dec-2015", "DEC-2015", "Foo-2015", "anF-2015", "Dec-0000", "Dec-0100",
              "Dec-15", "Dec-12015", "December-2015", "Dec 2015", "", None]
    assert as_text(sc.issue_month("x"), months) == as_text("try_to_date(x, 'MMM-yyyy')", months)


def test_two_dti_rules(spark):
    values = [-0.1, 0.0, 100.0, 200.0, 200.1, None]
    lenient = evaluate(spark, sc.in_range("x", 0, 200, keep_null=True), values, "double")
    strict = evaluate(spark, f"coalesce({sc.in_range('x', 0, 100, keep_null=False)}, false)", values, "double")
    assert lenient == [False, True, True, True, False, True]
    assert strict == [False, True, True, False, False, False]


def test_rounding_is_half_up_and_blind_to_noise(spark):
    values = [1.005, 0.285, 2.675, 1.0049999999999999, None]
    assert evaluate(spark, num.round_half_up("x", 2), values, "double") == [1.01, 0.29, 2.68, 1.01, None]


def test_ratios_with_zero_divisor(spark):
    assert evaluate(spark, num.ratio("1", "x"), [0, 3], "int") == [None, 0.3333]
    assert evaluate(spark, num.ratio_or_zero("1", "x"), [0], "int") == [0.0]


def test_keyed_hash_depends_on_salt_and_content_only(spark):
    a, b = (evaluate(spark, sc.keyed_hash(s, "x"), [7, None], "bigint") for s in ("a", "b"))
    assert a[0] != b[0] and None not in a
    assert evaluate(spark, sc.hash_slice("x", 1, 4), ["ffff00"]) == [65535]
