"""Classifier evaluation as aggregations: one job per report, whatever the thresholds.

All operators read ``label`` (0/1) and either ``prediction`` (0/1) or ``prob_1``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart import rules
from creditmart.functions import exprs, rows_of
from creditmart.functions import numbers as num

METRIC_DIGITS = 6

_PRECISION = num.ratio_or_zero("tp", "tp + fp")
_RECALL = num.ratio_or_zero("tp", "tp + fn")
_F1 = num.ratio_or_zero("2 * precision * recall", "precision + recall")
_FIGURES = ("precision", "recall", "f1")


def with_prediction(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    return scored.selectExpr("*", f"CAST(prob_1 >= {threshold}D AS int) AS prediction")


def _rounded(value: str, name: str) -> str:
    return f"{num.round_half_up(value, METRIC_DIGITS)} AS {name}"


def _with_figures(counts: DataFrame) -> DataFrame:
    """Add precision, recall and F1 to rows holding ``tp``, ``fp`` and ``fn``."""
    return counts.selectExpr("*", f"{_PRECISION} AS precision", f"{_RECALL} AS recall").selectExpr(
        "*", f"{_F1} AS f1"
    )


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("label", "prediction").agg(F.expr("count(1) AS cnt"))


def _per_class(predictions: DataFrame) -> DataFrame:
    """One row per class, each seen as the positive one, from a single confusion row."""
    cells = {
        "c11": "prediction = 1 AND label = 1",
        "c10": "prediction = 1 AND label = 0",
        "c01": "prediction = 0 AND label = 1",
        "c00": "prediction = 0 AND label = 0",
    }
    counted = predictions.agg(*exprs(f"count_if({test}) AS {name}" for name, test in cells.items()))
    classes = counted.selectExpr(
        rows_of(
            {"label": "0", "tp": "c00", "fp": "c01", "fn": "c10"},
            {"label": "1", "tp": "c11", "fp": "c10", "fn": "c01"},
        )
    )
    return _with_figures(classes).selectExpr("*", "tp + fn AS support")


def _weighted(figure: str) -> str:
    return f"try_divide(sum({figure} * support), sum(support))"


def classification_metrics(predictions: DataFrame) -> DataFrame:
    """Accuracy, support-weighted precision / recall / F1 and the positive-class figures."""
    return _per_class(predictions).agg(
        *exprs(
            [
                "sum(support) AS n",
                _rounded("try_divide(sum(tp), sum(support))", "accuracy"),
                *(_rounded(_weighted(f), f"weighted_{f}") for f in _FIGURES),
                *(_rounded(f"max({f}) FILTER (WHERE label = 1)", f"{f}_1") for f in _FIGURES),
            ]
        )
    )


def class_report(predictions: DataFrame) -> DataFrame:
    """Per-class precision, recall, F1 and support, with macro and weighted means.

    The means come from the one row per class, as a window over both would.
    """
    classes = _per_class(predictions).selectExpr(
        "CASE label WHEN 1 THEN 'Accepted' ELSE 'Rejected' END AS class", *_FIGURES, "support"
    )
    macro = classes.agg(*exprs(["'macro avg' AS class", *(f"avg({f}) AS {f}" for f in _FIGURES), "sum(support) AS support"]))
    weighted = classes.agg(
        *exprs(["'weighted avg' AS class", *(f"{_weighted(f)} AS {f}" for f in _FIGURES), "sum(support) AS support"])
    )
    return (
        classes.unionByName(macro)
        .unionByName(weighted)
        .selectExpr("class", *(_rounded(f, f) for f in _FIGURES), "support")
    )


def threshold_sweep(scored: DataFrame, thresholds: Sequence[float] = rules.REPORT_THRESHOLDS) -> DataFrame:
    """Counts and metrics at every threshold from one pass and one output row per threshold.

    The thresholds become columns of a single aggregation, so rows are not multiplied and
    one small partial row per task is all that is shuffled.
    """
    counts, rows = [], []
    for i, t in enumerate(thresholds):
        counts += [
            f"count_if(prob_1 >= {t}D AND label = 1) AS tp{i}",
            f"count_if(prob_1 >= {t}D AND label = 0) AS fp{i}",
            f"count_if(prob_1 < {t}D AND label = 1) AS fn{i}",
        ]
        rows.append({"threshold": f"{t}D", "tp": f"tp{i}", "fp": f"fp{i}", "fn": f"fn{i}"})
    swept = scored.agg(*exprs(counts)).selectExpr(rows_of(*rows))
    return _with_figures(swept).selectExpr("threshold", "tp", "fp", "fn", *(_rounded(f, f) for f in _FIGURES))


# Scores are ranked in 2**16 bins, each cut into 2**16 cells: resolution 2**-32.
_BIN_BITS = 16
_CELLS = 2 ** (2 * _BIN_BITS)
# Cells grow with the distance from 0 and from 1, below, between and beyond them: rare-event probabilities,
# near-certain ones and raw margins all spread. The place is -1..0 below 0, 0..2 inside, 2..3 above 1.
_NEAR, _FAR = "ln(1 + {} * pow(2, 60)) / ln(1 + pow(2, 59))", "ln(1 + {} * pow(2, 60)) / 760"
_SCORE_PLACE = (
    f"CASE WHEN isnan(prob_1) THEN 3.0D WHEN prob_1 < 0 THEN -{_FAR.format('(-prob_1)')} WHEN prob_1 <= 0.5D THEN {_NEAR.format('prob_1')} "
    f"WHEN prob_1 <= 1 THEN 2 - {_NEAR.format('(1 - prob_1)')} ELSE 2 + least({_FAR.format('(prob_1 - 1)')}, 1.0D) END"
)
# Never NULL by form, so that no join adds a filter to one reader of the score counts only
# and all of them share one shuffle.
_SCORE_CELL = f"coalesce(CAST(greatest(least(floor((({_SCORE_PLACE}) + 1) / 4 * {_CELLS}.0D), {_CELLS - 1}), 0) AS bigint), 0L)"


def score_counts_below(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct scores with their class counts and the counts of all smaller scores, of all rows or by some columns.

    A running sum over all distinct scores would be one task, so it is taken in three
    nested steps: over coarse bins, over fine bins inside a coarse bin, and over the
    distinct scores inside a fine bin. The bins only need to follow the score order.
    """
    scores = (
        scored.where("prob_1 IS NOT NULL")
        .groupBy(*by, "prob_1")
        .agg(*exprs(["count_if(label = 1) AS pos", "count_if(label = 0) AS neg"]))
        .selectExpr("*", f"{_SCORE_CELL} AS _cell", f"shiftright({_SCORE_CELL}, {_BIN_BITS}) AS _bin")
    )
    totals = exprs(["sum(pos) AS pos", "sum(neg) AS neg"])
    by_cell = scores.groupBy(*by, "_bin", "_cell").agg(*totals)
    by_bin = by_cell.groupBy(*by, "_bin").agg(*totals)  # at most 65,536 rows, or so many for each group

    def before(within: str, order: str, name: str) -> tuple[str, str]:
        within = ", ".join((*by, within))
        frame = f"(PARTITION BY {within} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        return f"sum(pos) OVER {frame} - pos AS pos_{name}", f"sum(neg) OVER {frame} - neg AS neg_{name}"

    everything = ", ".join((*by, "1"))
    bins = by_bin.selectExpr(
        *by,
        "_bin",
        *before("1", "_bin", "bins"),
        f"sum(pos) OVER (PARTITION BY {everything}) AS pos_total",
        f"sum(neg) OVER (PARTITION BY {everything}) AS neg_total",
    )
    cells = by_cell.selectExpr(*by, "_bin", "_cell", *before("_bin", "_cell", "cells"))
    ranked = scores.selectExpr("*", *before("_bin, _cell", "prob_1", "scores"))
    return (
        ranked.join(cells, on=[*by, "_bin", "_cell"])
        .join(bins if by else F.broadcast(bins), on=[*by, "_bin"])
        .selectExpr(
            *by,
            "prob_1",
            "pos",
            "neg",
            "pos_bins + pos_cells + pos_scores AS pos_below",
            "neg_bins + neg_cells + neg_scores AS neg_below",
            "pos_total",
            "neg_total",
        )
    )


def auc_rank(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact areas under the ROC and the precision-recall curve from per-score counts, of all rows or by some columns.

    ROC: the share of (positive, negative) pairs ranked correctly, ties counting half; the
    pairs are never formed. PR: trapezoids between neighbouring thresholds; the point
    before a threshold is that threshold less its own rows, so no neighbour is looked up,
    and the curve starts level with its first point.
    """
    points = (
        score_counts_below(scored, by)
        .selectExpr("*", "pos_total - pos_below AS tp", "neg_total - neg_below AS fp")
        .selectExpr("*", "tp / (tp + fp) AS prec", "try_divide(tp - pos, tp - pos + fp - neg) AS prec_before")
    )
    wins = "sum(CAST(pos AS double) * (neg_below + neg / 2))"
    area = "sum(try_divide(pos, pos_total) * (prec + coalesce(prec_before, prec)) / 2)"
    return points.groupBy(*by).agg(
        *exprs(
            [
                "sum(pos) AS n_pos",
                "sum(neg) AS n_neg",
                _rounded(f"try_divide({wins}, CAST(sum(pos) AS double) * sum(neg))", "auc_roc"),
                _rounded(area, "auc_pr"),
            ]
        )
    )
