"""Rate features: whole-table, from a training part only, and out of fold."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart import rules, schemas
from creditmart.functions import exprs
from creditmart.functions import numbers as num
from creditmart.functions import scalars as sc
from creditmart.operators import measures as m
from creditmart.sources.stage import stage

FOLD_SALT = "fold-42"


@dataclass(frozen=True)
class RateTable:
    """One lookup: its key, its rate, and further features (name -> aggregate)."""

    key: str
    rate: str
    others: tuple[tuple[str, str], ...]
    # True where the cleaning rules admit only a fixed list of keys (51 states,
    # 14 purposes): the table is then small whatever the data. Zip prefixes come from
    # free text, so their table is sized before the join instead.
    bounded: bool


RATE_TABLES = (
    RateTable("addr_state", "state_approval_rate", (("state_avg_dti", num.mean("dti", 4)),), True),
    RateTable("purpose", "purpose_approval_rate", (("purpose_avg_loan_amnt", num.mean("loan_amnt", 2)),), True),
    RateTable("zip_code", "zip_approval_rate", (), False),
)


def _for_join(table: RateTable, rates: DataFrame) -> DataFrame:
    """A bounded table is broadcast. The other is written and read back, so its true size
    is known when the join is planned: Catalyst broadcasts it below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where adaptive
    execution splits a hot key."""
    return F.broadcast(rates) if table.bounded else stage(rates, f"rates-{table.key}")


def rates_from_history(history: DataFrame) -> dict[str, DataFrame]:
    """The rate tables by key, computed from labelled rows."""
    return {
        table.key: history.groupBy(table.key).agg(
            *exprs([f"{m.RATE} AS {table.rate}", *(f"{text} AS {name}" for name, text in table.others)])
        )
        for table in RATE_TABLES
    }


def rates_from_summaries(geo: DataFrame, purpose: DataFrame, zips: DataFrame) -> dict[str, DataFrame]:
    """The rate tables by key, read off written summaries or published lookups: nothing is aggregated again."""
    return {
        "addr_state": geo.selectExpr("addr_state", "approval_rate AS state_approval_rate", "avg_dti AS state_avg_dti"),
        "purpose": purpose.selectExpr("purpose", "approval_rate AS purpose_approval_rate", "avg_loan_amnt AS purpose_avg_loan_amnt"),
        "zip_code": zips.selectExpr("zip_code", "approval_rate AS zip_approval_rate"),
    }


def join_rates(rows: DataFrame, rates: dict[str, DataFrame]) -> DataFrame:
    """Left-join rate tables and fill gaps. A key without a rate, or NULL, takes the default."""
    for table in RATE_TABLES:
        rows = rows.join(_for_join(table, rates[table.key]), on=table.key, how="left")
    return rows.fillna(rules.FEATURE_DEFAULTS)


def attach_rates(rows: DataFrame, history: DataFrame) -> DataFrame:
    """Join the rate features computed from ``history`` onto ``rows``.

    With ``history`` the same as ``rows`` this is plain target encoding (labels leak into the
    features); with a training part it is the leak-safe lookup for scoring new rows.
    """
    return join_rates(rows, rates_from_history(history))


def model_input(detail: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The feature table: three raw numbers, five rates or means, three categories, label."""
    return attach_rates(detail, detail).select(*carry, *schemas.FEATURES.names)


def out_of_fold_rates(detail: DataFrame, key: str, folds: int = 5) -> DataFrame:
    """Approval rates per segment in which no row's own label takes part.

    Rows are dealt into folds by key hash; a row gets its segment's rate over the other
    folds, i.e. (total - own fold) / (n - own fold), or the default when no other fold
    has the segment. Each lookup is one aggregation to (segment, fold) and a window over
    at most ``folds`` rows per segment.
    """
    fold = f"CAST({sc.hash_slice(sc.keyed_hash(FOLD_SALT, key), 1, 8)} % {folds} AS int) AS fold"
    dealt = detail.selectExpr("*", fold)
    rows = dealt
    for table in RATE_TABLES:
        name = f"oof_{table.rate}"
        others = f"(sum(_n) OVER (PARTITION BY {table.key}) - _n)"
        approved_others = f"(sum(_approved) OVER (PARTITION BY {table.key}) - _approved)"
        rates = (
            dealt.groupBy(table.key, "fold")
            .agg(*exprs([f"{m.N} AS _n", f"{m.N_APPROVED} AS _approved"]))
            .selectExpr(table.key, "fold", f"{num.ratio(approved_others, others)} AS {name}")
        )
        rows = rows.join(_for_join(table, rates), on=[table.key, "fold"], how="left")
        rows = rows.fillna({name: rules.FEATURE_DEFAULTS[table.rate]})
    return rows


def check_no_leakage(columns: Sequence[str]) -> None:
    """Raise if a column only known after the decision is among the features."""
    leaking = sorted(set(columns) & set(rules.POST_APPROVAL_COLUMNS))
    if leaking:
        raise ValueError(f"known only after approval: {', '.join(leaking)}")


def pre_approval(df: DataFrame) -> DataFrame:
    """The columns known before the decision, in the table's order."""
    return df.select(*(c for c in df.columns if c in rules.PRE_APPROVAL_COLUMNS))
