"""Sums of doubles that do not depend on the order of their rows.

A value is split into whole billions, whole units below a billion and billionths; each part is a
64-bit integer, whose sums are exact in any order and stay in generated code. Below 4e6 its nine decimals are
those of the value as written; a double beyond that has fewer than nine, all of which are kept. A part holds
9e9 rows of a group; then, and where groups are merged, the parts are one DECIMAL(38, 9). Values of 9e15
and more, infinities and NaN are summed apart, as doubles.

A *measure* ``x`` is kept as ``x_n`` (values that are not NULL), ``x_sum`` and ``x_far``. Merging is adding.
All functions return expression text.
"""

from __future__ import annotations

from collections.abc import Sequence

DECIMAL = "DECIMAL(38, 9)"
_FAR = "9.0E15D"
_GIGA = 1_000_000_000


def _parts(x: str) -> dict[str, str]:
    near = f"CASE WHEN abs({x}) < {_FAR} THEN {x} END"
    return {
        "giga": f"sum(floor({near}) div {_GIGA}L)",
        "unit": f"sum(floor({near}) % {_GIGA}L)",
        "nano": f"sum(CAST(round(({near} - floor({near})) * 1.0E9D) AS bigint))",
        "far": f"sum(CASE WHEN abs({x}) >= {_FAR} THEN {x} END)",
    }


def parts(measures: dict[str, str]) -> list[str]:
    """Aggregates of the first step: name -> value."""
    found = []
    for name, x in measures.items():
        found += [f"count({x}) AS {name}_n", *(f"{text} AS {name}_{part}" for part, text in _parts(x).items())]
    return found


def joined(names: Sequence[str]) -> list[str]:
    """Projections that turn the parts of each measure into its state; NULL where nothing was near."""
    found = []
    for name in names:
        # Widths that keep all nine digits: an addition that could need more than 38 would round.
        whole = f"CAST(CAST({name}_giga AS DECIMAL(20, 0)) * {_GIGA}BD + {name}_unit AS DECIMAL(27, 0))"
        total = f"CAST({whole} + CAST({name}_nano AS DECIMAL(20, 0)) * 0.000000001BD AS {DECIMAL})"
        found += [f"{name}_n", f"{total} AS {name}_sum", f"{name}_far"]
    return found


def merged(names: Sequence[str]) -> list[str]:
    """Aggregates that merge states of the same measures."""
    return [f"{text} AS {name}_{part}" for name in names for part, text in (("n", f"sum({name}_n)"), ("sum", f"sum({name}_sum)"), ("far", f"sum({name}_far)"))]


def mean(name: str, digits: int) -> str:
    """The rounded mean of a merged measure; NULL without values."""
    near = f"CAST(round(try_divide(sum({name}_sum), CAST(sum({name}_n) AS DECIMAL(20, 0))), {digits}) AS double)"
    far = f"round(try_divide(sum({name}_far), sum({name}_n)), {digits})"
    return f"CASE WHEN sum({name}_far) IS NULL THEN {near} ELSE coalesce({near}, 0.0D) + {far} END"


def deviation(name: str, squares: str, digits: int) -> str:
    """The rounded sample deviation, from a measure and the measure of its squares; NULL for fewer than two values."""
    n = f"CAST(sum({name}_n) AS DECIMAL(20, 0))"
    spread = f"CAST(sum({squares}_sum) - sum({name}_sum) * try_divide(sum({name}_sum), {n}) AS double)"
    return f"CASE WHEN sum({name}_n) > 1 THEN round(sqrt(greatest({spread}, 0.0D) / (sum({name}_n) - 1)), {digits}) END"
