"""Incremental refresh: detail and states are kept by month, and a changed month replaces its own.

A store is a folder with the cleaned rows and the states of both feeds, each a versioned table with a part
for each month (``sources.versions``). A refresh cleans the delivered months, replaces their rows, reads those
months alone back, and replaces their states. Marts are sums over all states, a few thousand rows a month, so they
equal a full rebuild to the last digit. Rows without a readable date are the part of month NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmart.operators import clean, states
from creditmart.plans import warehouse
from creditmart.sources import versions

MONTH = states.MONTH


@dataclass(frozen=True)
class Feed:
    name: str
    clean: Callable[[DataFrame], DataFrame]
    summarise: Callable[[DataFrame], DataFrame]


FEEDS = (
    Feed("rejected", lambda raw: clean.report_rejected(raw, require_date=False), states.rejected_states),
    Feed("accepted", clean.report_accepted, states.accepted_states),
)


def _schemas(spark: SparkSession, feed: Feed, raw: T.StructType) -> tuple[T.StructType, T.StructType]:
    rows = feed.clean(spark.createDataFrame([], raw))
    return rows.schema, feed.summarise(rows).schema


def _replace(raw: DataFrame, feed: Feed, folder: str, months: Sequence[str | None] | None) -> None:
    spark = raw.sparkSession
    rows = feed.clean(raw)
    if months is not None:
        known = [m for m in months if m is not None]
        wanted = F.col(MONTH).isin(known) if known else F.lit(False)
        rows = rows.where(wanted | F.col(MONTH).isNull() if None in months else wanted)
    row_schema, state_schema = _schemas(spark, feed, raw.schema)
    # Few files a month, and a large month in as many as it needs: adaptive execution decides.
    versions.replace(rows.hint("rebalance", MONTH), f"{folder}/{feed.name}", MONTH, months)
    fresh = feed.summarise(month_rows(spark, feed.name, folder, row_schema, months))
    versions.replace(fresh.select(*state_schema.names).repartition(MONTH), f"{folder}/{feed.name}-states", MONTH, months)


def month_rows(spark: SparkSession, name: str, folder: str, schema: T.StructType, months: Sequence[str | None] | None) -> DataFrame:
    """The cleaned rows of some months; no other month's folder is opened."""
    return versions.read(spark, f"{folder}/{name}", schema, months)


def load(raw_rejected: DataFrame, raw_accepted: DataFrame, folder: str) -> None:
    """Fill a store from whole feeds."""
    for feed, raw in zip(FEEDS, (raw_rejected, raw_accepted), strict=True):
        _replace(raw, feed, folder, None)


def refresh(raw_rejected: DataFrame, raw_accepted: DataFrame, months: Sequence[str | None], folder: str) -> None:
    """Replace months (``yyyy-MM``, or None for undated rows) by what the feeds now hold of them. Other rows of the feeds are passed over."""
    for feed, raw in zip(FEEDS, (raw_rejected, raw_accepted), strict=True):
        _replace(raw, feed, folder, months)


def stored_states(raw_rejected: DataFrame, raw_accepted: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """The states of a store; the feeds give their schemas only."""
    spark = raw_rejected.sparkSession
    found = []
    for feed, raw in zip(FEEDS, (raw_rejected, raw_accepted), strict=True):
        found.append(versions.read(spark, f"{folder}/{feed.name}-states", _schemas(spark, feed, raw.schema)[1]))
    return found[0], found[1]


def marts(raw_rejected: DataFrame, raw_accepted: DataFrame, folder: str) -> dict[str, DataFrame]:
    """All reporting marts of a store, unpublished."""
    held = stored_states(raw_rejected, raw_accepted, folder)
    return {name: build(*held) for name, build in warehouse.ROLLUPS.items()}
