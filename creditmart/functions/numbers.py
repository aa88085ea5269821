"""Number handling that gives the same answer under every partitioning."""

from __future__ import annotations

# Decimals kept before the reported rounding. A mean of doubles depends on the order the
# partial sums arrive in by about 1e-12; dropping that noise first keeps exact ties
# (x.xx5) from rounding up in one run and down in the next.
GUARD_DIGITS = 10


def round_half_up(value: str, digits: int) -> str:
    return f"round(round({value}, {GUARD_DIGITS}), {digits})"


def to_number(text: str) -> str:
    """Text to double; anything unreadable becomes NULL instead of failing the job."""
    return f"try_cast({text} AS double)"


def parse_percent(text: str) -> str:
    """``"12.5%"`` and ``"12.5"`` to 12.5; unreadable text to NULL."""
    return to_number(f"replace({text}, '%', '')")


def ratio(part: str, whole: str, digits: int = 4) -> str:
    """Rounded quotient, NULL when the divisor is zero."""
    return round_half_up(f"try_divide({part}, {whole})", digits)


def percent(part: str, whole: str, digits: int = 2) -> str:
    return ratio(f"{part} * 100.0D", whole, digits)


def mean(value: str, digits: int) -> str:
    return round_half_up(f"avg({value})", digits)


def ratio_or_zero(part: str, whole: str) -> str:
    """Unrounded quotient, 0 when undefined (the convention of classifier metrics)."""
    return f"coalesce(try_divide({part}, {whole}), 0.0D)"
