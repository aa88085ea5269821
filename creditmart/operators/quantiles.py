"""Exact quantiles over any number of rows, with only small histograms shuffled.

Spark's exact ``percentile`` keeps every distinct value of a group in one buffer, and
``percentile_approx`` tight enough to be exact ships a sketch per task that grows with
its accuracy. Here the wanted ranks are located by the bits of the values:

1. a value's 64 bits as a signed integer are its ``key``, in the order of the values;
2. values are counted by the first 13 bits of their keys (sign, exponent, one bit more); in the cells that hold a
   wanted rank, by the next 12 bits; and so on, until each such cell has one value or at most ``CELL_ROWS`` rows;
3. in these cells the distinct values are counted and ranked.

Each pass is a scan whose shuffle is a histogram of at most 8,192 rows per cell, pre-aggregated on the map side, so
neither a group nor a single value with a third of all rows makes a heavy task, and millions of distinct values that
agree in their leading bits only take more passes, six at most.

Groups are labels or column names, a few by construction. What is broadcast is the cells still in play: at most two
per group and quantile. The input is read three times as a rule, so stage it first when it is costly (``sources.stage``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.functions import exprs
from creditmart.sources.stage import stage

CELL_ROWS = 65_536
SHIFTS = (51, 39, 27, 15, 3, 0)


def keyed(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """``*groups, _v, _k``: the values that are not NULL, and their bits as an integer in the same order.

    The bits are computed by exact steps: scaling by powers of two, and the exponent from a logarithm set right by comparison.
    Zeros are one value; NaN comes last.
    """
    size = df.selectExpr(*groups, f"CAST({value} AS double) AS _v").where("_v IS NOT NULL").selectExpr("*", "abs(_v) AS _a")
    guess = size.selectExpr("*", "CASE WHEN _a >= 2.2250738585072014E-308D AND _a <= 1.7976931348623157E308D THEN least(greatest(floor(log2(_a)), -1022L), 1023L) END AS _e")
    exponent = guess.selectExpr("_v", "_a", *groups, "_e + CASE WHEN _a < power(2.0D, _e) THEN -1L WHEN _e < 1023 AND _a >= power(2.0D, _e + 1) THEN 1L ELSE 0L END AS _e")
    size_key = (
        "CASE WHEN _e IS NOT NULL THEN (_e + 1023) * 4503599627370496L + CAST((_a / power(2.0D, _e) - 1.0D) * 4503599627370496.0D AS bigint) "
        "WHEN isnan(_a) THEN 2047L * 4503599627370496L + 1L WHEN _a > 1.0D THEN 2047L * 4503599627370496L "
        "ELSE CAST(_a * power(2.0D, 537) * power(2.0D, 537) AS bigint) END"
    )
    return exponent.selectExpr(*groups, "_v", f"{size_key} * CASE WHEN _v < 0 THEN -1L ELSE 1L END AS _k")


def _wanted_ranks(probabilities: Sequence[float], interpolate: bool) -> str:
    """Array of (slot, 1-based rank) of every order statistic needed, in terms of ``_n``."""
    wanted = []
    for i, p in enumerate(probabilities):
        if interpolate:
            spot = f"{p}D * (_n - 1)"
            ranks = (f"floor({spot}) + 1", f"ceil({spot}) + 1")
        else:
            ranks = (f"greatest(ceil({p}D * _n), 1)",)
        for side, rank in enumerate(ranks):
            wanted.append(f"named_struct('slot', {2 * i + side}, 'rank', CAST({rank} AS bigint))")
    return f"array({', '.join(wanted)})"


def _located(histogram: DataFrame, within: Sequence[str], order: str, keep: Sequence[str]) -> DataFrame:
    """The histogram rows holding a wanted rank; ranks become relative to the row."""
    frame = f"PARTITION BY {', '.join(within)} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    here = (
        "transform(filter(_want, w -> w.rank > _before AND w.rank <= _before + _c), "
        "w -> named_struct('slot', w.slot, 'rank', w.rank - _before)) AS _want"
    )
    counted = histogram.selectExpr("*", f"sum(_c) OVER ({frame}) - _c AS _before")
    return counted.selectExpr(*keep, here).where("size(_want) > 0")


def _inside(base: DataFrame, cells: DataFrame, groups: Sequence[str], shift: int) -> DataFrame:
    """Rows of the cells in play, with the cell's ranks. A cell is the keys that agree but for their last ``shift`` bits."""
    same_group = " AND ".join(f"b.{g} = r.{g}" for g in groups)
    joined = base.alias("b").join(F.broadcast(cells).alias("r"), F.expr(f"{same_group} AND shiftright(_k, {shift}) = _cell"))
    return joined.selectExpr(*(f"b.{g} AS {g}" for g in groups), "_v", "_k", "_n", "_cell AS _in", "_want")


def refined(base: DataFrame, groups: Sequence[str], probabilities: Sequence[float], interpolate: bool) -> tuple[DataFrame, int]:
    """The cells that hold a wanted rank (``*groups, _n, _cell, _c, _want``), and how many bits of the keys they leave open."""
    tally = exprs(["count(1) AS _c", "min(_k) < max(_k) AS _several"])
    keep = [*groups, "_n", "_cell", "_c", "_several"]
    cells, before = None, 0
    for shift in SHIFTS:
        cell = F.expr(f"shiftright(_k, {shift}) AS _cell")
        if cells is None:
            counted = (
                base.groupBy(*groups, cell).agg(*tally)
                .selectExpr("*", f"sum(_c) OVER (PARTITION BY {', '.join(groups)}) AS _n")
                .selectExpr("*", f"{_wanted_ranks(probabilities, interpolate)} AS _want")
            )
            located = _located(counted, groups, "_cell", keep)
        else:
            counted = _inside(base, cells, groups, before).groupBy(*groups, "_n", "_in", "_want", cell).agg(*tally)
            located = _located(counted, [*groups, "_in"], "_cell", keep)
        cells, before = stage(located, "quantile-cells"), shift
        if not cells.where(f"_several AND _c > {CELL_ROWS}").limit(1).count():
            break
    return cells, before


def order_statistics(
    df: DataFrame, groups: Sequence[str], value: str, probabilities: Sequence[float], interpolate: bool
) -> DataFrame:
    """Rows ``(*groups, _n, _slot, _value)``: slot ``2i`` is the lower order statistic of
    ``probabilities[i]`` and ``2i + 1`` the upper one (interpolated form only)."""
    groups = list(groups)
    base = keyed(df, groups, value)
    cells, shift = refined(base, groups, probabilities, interpolate)
    values = _inside(base, cells, groups, shift).groupBy(*groups, "_n", "_in", "_want", "_v").agg(F.expr("count(1) AS _c"))
    return _located(values, [*groups, "_in"], "_v", [*groups, "_n", "_v"]).selectExpr(
        *groups, "_n", "explode(_want.slot) AS _slot", "_v AS _value"
    )


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probabilities: dict[str, float],
    interpolate: bool = False,
) -> DataFrame:
    """One row per group with a column per entry of ``probabilities`` (name -> p).

    Without interpolation a quantile is the smallest value with at least ``p * n`` values
    at or below it; with it, the linear interpolation between neighbouring values.
    Missing values are left out, and a group without values yields no row.
    """
    found = order_statistics(df, groups, value, list(probabilities.values()), interpolate)

    def at(slot: int) -> str:
        return f"max(_value) FILTER (WHERE _slot = {slot})"

    columns = []
    for i, (name, p) in enumerate(probabilities.items()):
        quantile = at(2 * i)
        if interpolate:
            spot = f"{p}D * (first(_n) - 1)"
            quantile = f"{quantile} + ({at(2 * i + 1)} - {quantile}) * ({spot} - floor({spot}))"
        columns.append(f"{quantile} AS {name}")
    return found.groupBy(*groups).agg(*exprs(columns))
