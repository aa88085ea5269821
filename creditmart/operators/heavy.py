"""The most frequent values of a column, exactly, without shuffling every distinct value.

Free text has about as many distinct values as rows. So rows are first counted in two tables of ``BUCKETS`` hash
buckets each: a summary of fixed size, which tasks fill and the shuffle adds up. A value occurs at most as often as its
bucket, in either table. The values in the fullest buckets are counted exactly; the k-th of these counts is a floor
that every value of the top k reaches, so only values whose two buckets both reach it can be among them. Those are
counted exactly, which proves the answer. Where the floor is low (hardly any value repeats), most
buckets reach it and this is the full count.

NULL is a value like any other. The column is read three times, so stage it first when it is costly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.functions import rows_of
from creditmart.sources.stage import stage

BUCKETS = 1 << 16
FIRST_LOOK = 8  # buckets looked into for each value wanted

_SLOTS = tuple(f"pmod(xxhash64({salt}, _value IS NULL, _value), {BUCKETS})" for salt in (1, 2))


def bucket_counts(df: DataFrame, column: str) -> DataFrame:
    """``_table, _bucket, _c``: rows by bucket, in two tables."""
    values = df.selectExpr(f"`{column}` AS _value")
    slots = values.selectExpr(rows_of(*({"_table": str(i), "_bucket": slot} for i, slot in enumerate(_SLOTS))))
    return slots.groupBy("_table", "_bucket").agg(F.count("*").alias("_c"))


def _in_buckets(df: DataFrame, column: str, buckets: list[DataFrame]) -> DataFrame:
    """Rows whose value lies in the buckets given for the first table, or for both."""
    rows = df.selectExpr(f"`{column}` AS _value")
    for slot, held in zip(_SLOTS, buckets, strict=False):
        rows = rows.selectExpr("*", f"{slot} AS _slot").join(F.broadcast(held.selectExpr("_bucket AS _slot")), "_slot", "left_semi").drop("_slot")
    return rows


def survivors(df: DataFrame, column: str, k: int) -> tuple[DataFrame, DataFrame]:
    """The rows whose values may be among the k most frequent, and the bucket counts (staged)."""
    counts = stage(bucket_counts(df, column), "bucket-counts")
    tables = [counts.where(F.col("_table") == i).drop("_table") for i in range(2)]
    fullest = tables[0].orderBy(F.desc("_c"), "_bucket").limit(k * FIRST_LOOK)
    looked = _in_buckets(df, column, [fullest]).groupBy("_value").agg(F.count("*").alias("_c"))
    floor = [r["_c"] for r in looked.orderBy(F.desc("_c")).limit(k).select("_c").collect()]
    least = floor[-1] if len(floor) == k else 0
    return _in_buckets(df, column, [t.where(F.col("_c") >= least) for t in tables]), counts


def top_k_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """``column, cnt, total``: the k most frequent values, ties by value, with the number of all rows."""
    rows, counts = survivors(df, column, k)
    total = counts.where("_table = 0").agg(F.sum("_c")).scalar()
    top = rows.groupBy("_value").agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), F.asc_nulls_first("_value")).limit(k)
    return top.withColumn("total", total).selectExpr(f"_value AS `{column}`", "cnt", "total")
