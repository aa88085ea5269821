"""Domain expressions: validation, standardisation, bands, dates, keyed hashes."""

from __future__ import annotations

from collections.abc import Sequence

from creditmart import rules
from creditmart.functions import in_list, lookup, quote

# --- predicates -----------------------------------------------------------------


def valid_state(state: str) -> str:
    return in_list(state, rules.VALID_STATES)


def valid_employment(label: str) -> str:
    """One of the eleven labels. Empty and NULL do not qualify, nor do padded labels."""
    return in_list(label, rules.EMPLOYMENT_YEARS)


def in_range(value: str, low: float, high: float, keep_null: bool) -> str:
    """``low <= value <= high``; ``keep_null`` decides whether a missing value passes."""
    inside = f"({value} BETWEEN {low} AND {high})"
    return f"({value} IS NULL OR {inside})" if keep_null else inside


def conforms(value: str, pattern: str) -> str:
    return f"rlike({value}, {quote(pattern)})"


def is_blank(value: str) -> str:
    """NULL or the empty string."""
    return f"({value} IS NULL OR CAST({value} AS string) = '')"


def owns_or_rents(home: str) -> str:
    return f"({home} IS NOT NULL AND NOT {in_list(home, rules.EXCLUDED_HOME_OWNERSHIP)})"


# --- standardisation ------------------------------------------------------------


def purpose_key(text: str) -> str:
    return f"lower(trim({text}))"


def purpose_of_key(key: str) -> str:
    """Purpose class of text already passed through :func:`purpose_key`.

    The key is read up to two dozen times, so it should be a column of its own (see
    ``operators.clean.with_purpose``) rather than an inlined expression.
    """
    cases = (
        f"WHEN {' OR '.join(f'contains({key}, {quote(n)})' for n in needles)} THEN {quote(purpose)}"
        for purpose, needles in rules.PURPOSE_RULES
    )
    return f"CASE {' '.join(cases)} ELSE {quote(rules.PURPOSE_OTHER)} END"


def normalize_purpose(text: str) -> str:
    return purpose_of_key(purpose_key(text))


def employment_years(label: str) -> str:
    return lookup(rules.EMPLOYMENT_YEARS, label)


def employment_label(years: str) -> str:
    """Years back to a label. One year reads "1 years": the published reports do."""
    return (
        f"CASE WHEN {years} IS NULL THEN 'Unknown' WHEN {years} = 0 THEN '< 1 year' "
        f"WHEN {years} = 10 THEN '10+ years' ELSE concat(CAST({years} AS int), ' years') END"
    )


def zip_prefix(zip_code: str) -> str:
    return f"substring({zip_code}, 1, 3)"


def simplify_status(status: str) -> str:
    """Four classes; every status not named, NULL too, counts as past due."""
    return (
        f"CASE WHEN {status} = {quote(rules.STATUS_PAID)} THEN {quote(rules.STATUS_PAID)} "
        f"WHEN {status} = {quote(rules.STATUS_CURRENT)} THEN {quote(rules.STATUS_CURRENT)} "
        f"WHEN {in_list(status, rules.DEFAULTED_STATUSES)} THEN {quote(rules.STATUS_CHARGED_OFF)} "
        f"ELSE {quote(rules.STATUS_LATE)} END"
    )


def is_charged_off(status: str) -> str:
    return f"CASE WHEN {in_list(status, rules.DEFAULTED_STATUSES)} THEN 1 ELSE 0 END"


def state_name(code: str) -> str:
    return lookup(rules.STATE_NAMES, code)


# --- bands ------------------------------------------------------------------------


def band(value: str, edges: Sequence[float], labels: Sequence[str]) -> str:
    """Half-open bands ``[lower, upper)``. NULL lands in the top band; filter first."""
    cases = (f"WHEN {value} < {edge} THEN {quote(label)}" for edge, label in zip(edges, labels[:-1], strict=True))
    return f"CASE {' '.join(cases)} ELSE {quote(labels[-1])} END"


def dti_band(value: str) -> str:
    return band(value, *rules.DTI_BANDS)


def amount_band(value: str) -> str:
    return band(value, *rules.AMOUNT_BANDS)


def income_band(value: str) -> str:
    return band(value, *rules.INCOME_BANDS)


def score_band(value: str) -> str:
    return band(value, *rules.SCORE_BANDS)


# --- dates ------------------------------------------------------------------------


# The formatter behind try_to_date costs several times a plain parse. Text of exactly the
# usual shape, where both agree, takes the plain one; anything else goes to the formatter.

_MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def application_day(text: str) -> str:
    """``yyyy-MM-dd`` text to a date, NULL when unreadable."""
    return (
        f"CASE WHEN {conforms(text, '^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}$')} THEN try_cast({text} AS date) "
        f"ELSE try_to_date({text}, 'yyyy-MM-dd') END"
    )


def issue_month(text: str) -> str:
    """``MMM-yyyy`` text to the first day of the month, NULL when unreadable."""
    month = f"(instr({quote(''.join(_MONTHS))}, substring({text}, 1, 3)) + 2) DIV 3"
    usual = conforms(text, f"^({'|'.join(_MONTHS)})-[1-9][0-9]{{3}}$")
    return (
        f"CASE WHEN {usual} THEN make_date(CAST(substring({text}, 5, 4) AS int), CAST({month} AS int), 1) "
        f"ELSE try_to_date({text}, 'MMM-yyyy') END"
    )


def year_month(day: str) -> str:
    return f"concat(year({day}), '-', lpad(CAST(month({day}) AS string), 2, '0'))"


# --- keyed hashing ------------------------------------------------------------------


def keyed_hash(salt: str, key: str) -> str:
    """Hex digest of ``salt:key``: the same for a row wherever and whenever it is read."""
    return f"md5(concat({quote(salt + ':')}, coalesce(CAST({key} AS string), '')))"


def hash_slice(digest: str, start: int, length: int) -> str:
    """``length`` hex digits of a digest from 1-based ``start`` as a number."""
    return f"CAST(conv(substring({digest}, {start}, {length}), 16, 10) AS bigint)"
