"""Sampling and splitting by keyed hash: the same rows on every run and partitioning.

Spark's ``sample`` and ``randomSplit`` draw per partition, so a different file layout or
a recomputed task gives other rows. Here a row's fate depends on its content only.
Each use has its own salt: one hash for both undersampling and splitting would make the
test set a function of which rows were kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.functions import exprs, rows_of
from creditmart.functions import numbers as num
from creditmart.functions import scalars as sc
from creditmart.operators import measures as m
from creditmart.sources.stage import stage

# --- fixed values: salts and the 32-bit range a hash slice covers -----------------
SPLIT_SALT = "42"
UNDERSAMPLE_SALT = "under-42"
STRATIFY_SALT = "strata-42"
SAMPLE_SALT = "sample-42"
VALIDATION_SALT = "valid-42"
_SLICE_RANGE = 2**32

# Copies of one identical row are emitted in runs of at most this many.
_COPY_RUN = 1_000_000


def _class_counts(df: DataFrame) -> DataFrame:
    return df.agg(*exprs([f"{m.N_REJECTED} AS n_rejected", f"{m.N_APPROVED} AS n_approved"]))


def class_balance(df: DataFrame) -> DataFrame:
    """Rows per class and the imbalance ratio, from one aggregation."""
    return _class_counts(df).selectExpr("*", f"{num.ratio('n_rejected', 'n_approved')} AS imbalance_ratio")


# --- Bernoulli forms ---------------------------------------------------------------


def hash_share(salt: str, key: str) -> str:
    """A uniform number in [0, 1) fixed by the key."""
    return f"({sc.hash_slice(sc.keyed_hash(salt, key), 1, 8)} / {_SLICE_RANGE}.0D)"


def undersample_hash(df: DataFrame, key: str, ratio: float = 2.0) -> DataFrame:
    """Keep every approval and a share of rejections near ``ratio`` times as many.

    The share is a scalar subquery, so the counting pass is part of the plan and nothing
    is collected.
    """
    share = _class_counts(df).selectExpr(f"least(1.0D, try_divide(n_approved * {ratio}D, n_rejected))")
    keep = F.expr(hash_share(UNDERSAMPLE_SALT, key)) < share.scalar()
    return df.where(F.expr("label = 1") | keep)


def split_hash(df: DataFrame, key: str, train_pct: int = 80) -> DataFrame:
    """Label every row ``train`` or ``test`` in column ``split``."""
    bucket = f"{sc.hash_slice(sc.keyed_hash(SPLIT_SALT, key), 1, 8)} % 100"
    return df.selectExpr("*", f"CASE WHEN {bucket} < {train_pct} THEN 'train' ELSE 'test' END AS split")


def validation_flag(df: DataFrame, key: str, share: float = 0.2) -> DataFrame:
    """Mark a held-out part of the training rows, for early stopping."""
    return df.selectExpr("*", f"{hash_share(VALIDATION_SALT, key)} < {share}D AS is_validation")


# --- exact sizes -------------------------------------------------------------------


def _cutoff(counts: DataFrame, within: str, bucket: str, keep: Sequence[str]) -> DataFrame:
    """The bucket in which each group's quota is reached, and what is left for it there."""
    frame = f"PARTITION BY {within} ORDER BY {bucket} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return (
        counts.selectExpr("*", f"sum(_c) OVER ({frame}) - _c AS _before")
        .where("_before < _quota AND _quota <= _before + _c")
        .selectExpr(*keep, "_quota - _before AS _quota")
    )


#: Hex digits a pass goes on by, digits of one digest, and rows that may be ranked in one place.
_STEP, _DIGEST, BOUNDARY_ROWS = 3, 32, 65_536


def _order_text(digits: int, columns: Sequence[str]) -> str:
    """What rows are ordered by, as far as so many digits need it: the key's digest, then one of the whole row."""
    if digits <= _DIGEST:
        return "_digest"
    return f"concat(_digest, md5(to_json(struct({', '.join(f'CAST({c} AS string) AS c{i}' for i, c in enumerate(columns))}))))"


def _boundaries(hashed: DataFrame, wanted: DataFrame, group: str, columns: Sequence[str]) -> tuple[DataFrame, int]:
    """``group, _cut, _quota``: the first digits of the rows where each quota is reached, what is left for it there; and how many digits.

    Digits are added until those rows are few or all alike.
    """
    cells, digits, reach = wanted.selectExpr(group, "'' AS _cut", "_quota"), 0, _STEP
    while True:
        inside = hashed.selectExpr("*", f"{_order_text(reach, columns)} AS _order").join(F.broadcast(cells), on=group)
        tally = exprs(["count(1) AS _c", "min(_order) < max(_order) AS _several"])
        counts = (
            inside.where(f"substring(_order, 1, {digits}) = _cut")
            .groupBy(group, "_quota", F.expr(f"substring(_order, 1, {reach}) AS _next"))
            .agg(*tally)
        )
        found = stage(_cutoff(counts, group, "_next", [group, "_next AS _cut", "_c", "_several"]), "sample-cells")
        cells, digits = found.select(group, "_cut", "_quota"), reach
        full = found.where(f"_c > {BOUNDARY_ROWS}").select("_several").collect()  # a row per group at most
        alike = not any(r["_several"] for r in full)
        if not full or digits >= 2 * _DIGEST or digits > _DIGEST and alike:
            return cells, digits
        # Where each of them has one key, the rest of its digest tells nothing apart: on to the row's.
        reach = (_DIGEST if digits <= _DIGEST and alike else digits) + _STEP


def mark_exactly(df: DataFrame, quotas: DataFrame, group: str, key: str, salt: str) -> DataFrame:
    """Add ``picked``: true for exactly ``quota`` rows of every group, in hash order of ``key``.

    ``quotas`` has one row ``(group, quota)`` per class, with ``quota`` at most the size
    of the group; no row in a group without quota is picked.

    4,096-way histograms of the hash find where each quota is reached, one for every three hex digits, until at most
    ``BOUNDARY_ROWS`` rows of a group share the digits found, or only copies of one row do. Where the key's digits do not
    tell rows apart, those of the whole row follow. Rows below or above that point are decided as they stream by; only
    the rows at it are ranked. Identical rows are counted, not listed, so a pile of copies at the boundary cannot
    overload the ranking, and since the order is by content a recomputed task decides the same way.

    ``quotas`` is broadcast: it has one row per class. ``df`` is read three times as a rule, so stage
    it first when it is costly.
    """
    columns = df.columns
    hashed = df.selectExpr("*", f"{sc.keyed_hash(salt, key)} AS _digest")
    cells, digits = _boundaries(hashed, quotas.selectExpr(group, "CAST(quota AS bigint) AS _quota"), group, columns)
    ordered = hashed.selectExpr("*", f"{_order_text(digits, columns)} AS _order")
    placed = ordered.join(F.broadcast(cells), on=group, how="left")
    boundary, below = f"substring(_order, 1, {digits}) = _cut", f"substring(_order, 1, {digits}) < _cut"
    decided = placed.where(f"NOT coalesce({boundary}, false)").selectExpr(
        *columns, f"coalesce({below}, false) AS picked"
    )

    order = f"PARTITION BY {group} ORDER BY _order, {', '.join(columns)}"
    taken = "greatest(least(_c, _quota - _before), 0)"
    ranked = (
        placed.where(boundary)
        .groupBy(*columns, "_order", "_quota")
        .agg(F.expr("count(1) AS _c"))
        .selectExpr(
            "*", f"sum(_c) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - _c AS _before"
        )
        .selectExpr(
            *columns,
            rows_of(
                {"picked": "true", "_copies": taken},
                {"picked": "false", "_copies": f"_c - {taken}"},
            ),
        )
        .where("_copies > 0")
    )
    return decided.unionByName(_repeat(ranked, "_copies").select(*columns, "picked"))


def take_exactly(df: DataFrame, quotas: DataFrame, group: str, key: str, salt: str) -> DataFrame:
    """The picked rows of :func:`mark_exactly`; the test is pushed into both its branches."""
    return mark_exactly(df, quotas, group, key, salt).where("picked").drop("picked")


def _repeat(df: DataFrame, copies: str) -> DataFrame:
    """Each row ``copies`` times, in runs, so that a large count is not one large array."""
    runs = f"explode(sequence(0L, ({copies} - 1) DIV {_COPY_RUN})) AS _run"
    in_run = f"least({copies} - _run * {_COPY_RUN}, {_COPY_RUN}L)"
    return df.selectExpr("*", runs).selectExpr("*", f"explode(sequence(1L, {in_run})) AS _copy")


def undersample_exact(df: DataFrame, key: str, ratio: int = 2) -> DataFrame:
    """Every approval and exactly ``min(ratio * approvals, rejections)`` rejections."""
    quotas = _class_counts(df).selectExpr(
        rows_of(
            {"label": "0", "quota": f"least(n_approved * {ratio}, n_rejected)"},
            {"label": "1", "quota": "n_approved"},
        )
    )
    return take_exactly(df, quotas, "label", key, UNDERSAMPLE_SALT)


def train_quotas(df: DataFrame, test_share: float = 0.2) -> DataFrame:
    """Training rows per class so that the parts keep the class mix and the exact total.

    The test part has ``ceil(test_share * n)`` rows. Each class gets its proportional
    share of the rest rounded down, and the rows still missing go to the classes with
    the largest fractions. The windows run over one row per class.
    """
    return (
        df.groupBy("label")
        .agg(F.expr("count(1) AS n"))
        .selectExpr("label", "n", "sum(n) OVER (PARTITION BY 1) AS total")
        .selectExpr("label", "n", "total", f"total - ceil(total * {test_share}D) AS train_total")
        .selectExpr("label", "train_total", "CAST(n AS double) * train_total / total AS exact")
        .selectExpr("label", "train_total", "exact", "floor(exact) AS base")
        .selectExpr(
            "label",
            "base",
            "train_total - sum(base) OVER (PARTITION BY 1) AS missing",
            "row_number() OVER (PARTITION BY 1 ORDER BY exact - base DESC, label) AS place",
        )
        .selectExpr("label", "base + CASE WHEN place <= missing THEN 1 ELSE 0 END AS quota")
    )


def split_stratified(df: DataFrame, key: str, test_share: float = 0.2) -> DataFrame:
    """Exact stratified split: the training rows of every class are an exact-size draw."""
    marked = mark_exactly(df, train_quotas(df, test_share), "label", key, STRATIFY_SALT)
    return marked.selectExpr(*df.columns, "CASE WHEN picked THEN 'train' ELSE 'test' END AS split")


def sample_scan(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows (all, if fewer) for a look at the data, independent of file order."""
    # One group for all rows. It is 0 for every key but no literal, which Catalyst would fold
    # out of the joins with the quota, leaving nested loops instead of hash joins.
    one = df.selectExpr("*", f"coalesce(length(substring(CAST({key} AS string), 1, 0)), 0) AS _all")
    quotas = one.groupBy("_all").agg(F.expr(f"least(count(1), {n}) AS quota"))
    return take_exactly(one, quotas, "_all", key, SAMPLE_SALT).drop("_all")
