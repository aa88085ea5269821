"""Exact de-duplication by two-pass Bloom filtering, in DataFrame operations only.

Pass 1 hashes every normalised text into ``HASHES`` slots and counts the rows of each slot; slots
that two or more rows fill become the bits of a repeat filter. Pass 2 asks the filter about every
row: a row with a slot of its own cannot have an equal and passes straight through, only the
possibly repeated rows are shuffled by digest. What the filter passes wrongly is settled there by
the digest, so the result is exact at every filter size.

Texts are equal when they are identical without the characters space, tab, newline, vertical tab,
form feed and carriage return. Of equal texts, the row with the most code points stays, then the
smallest id (a null id comes last), then any one of the rows that agree in both. Defined cases: a
null text counts as empty, and all empty texts are equal; an empty table gives an empty result;
columns besides id and text are carried unread, whatever their names.

Scale: the filter has a fixed largest size, ``MAX_BITS`` bits per hash (32 MiB each), and is the
only thing broadcast; on tables too large for it more rows are shuffled, with the same result. A
digest that a third of all rows share is reduced to one row per task before the shuffle; where
rows must learn their group's winner, adaptive execution splits the hot digest, because both sides
of that join are plain scans of staged tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import WHITE, fresh, whole_text, without
from creditmart.sources.stage import stage

HASHES = 2
BITS_PER_ROW = 32
MIN_BITS = 1 << 15  # one bitmap of Spark's bitmap functions
MAX_BITS = 1 << 28


def normal_digest(text: str) -> Column:
    """SHA-256 of the text without white space, as lower-case hex."""
    return F.sha2(without(whole_text(text), WHITE), 256)


def _slot(digest: Column, which: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(digest, F.lit(which)), F.lit(bits))


def filter_bits(rows: int) -> int:
    """Bits of one hash's filter: a power of two."""
    return min(MAX_BITS, max(MIN_BITS, 1 << max(0, rows * BITS_PER_ROW - 1).bit_length()))


def repeat_filter(digests: DataFrame, digest: str, bits: int) -> DataFrame:
    """(which, bucket, bitmap): the slots that more than one row fills."""
    slots = F.array(*(F.struct(F.lit(k).alias("which"), _slot(F.col(digest), k, bits).alias("slot")) for k in range(HASHES)))
    return _bitmaps(digests.select(F.inline(slots)).groupBy("which", "slot").agg(F.count("*").alias("n")).filter("n > 1"))


def slots_as_bitmaps(rows: DataFrame, value: Column, bits: int) -> DataFrame:
    """The same for a plain Bloom filter: the slots that any row's value fills."""
    return _bitmaps(rows.select(F.inline(F.array(*(F.struct(F.lit(k).alias("which"), _slot(value, k, bits).alias("slot")) for k in range(HASHES))))))


def _bitmaps(slots: DataFrame) -> DataFrame:
    # The bitmap functions count buckets from 1 and positions from 0 for values from 1.
    value = F.col("slot") + 1
    return slots.groupBy("which", F.bitmap_bucket_number(value).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bitmap")
    )


def flag_repeats(rows: DataFrame, digest: str, bitmaps: DataFrame, bits: int, flag: str) -> DataFrame:
    """The rows with a boolean: whether an equal row may exist. No row is shuffled."""
    columns = rows.columns
    verdict = F.lit(True)
    for k in range(HASHES):
        bucket, bitmap = fresh(rows, f"bucket{k}", f"bitmap{k}")
        one = bitmaps.filter(F.col("which") == k).select(F.col("bucket").alias(bucket), F.col("bitmap").alias(bitmap))
        value = _slot(F.col(f"`{digest}`"), k, bits) + 1
        rows = rows.withColumn(f"{bucket}_own", F.bitmap_bucket_number(value))
        rows = rows.join(F.broadcast(one), F.col(f"{bucket}_own") == F.col(bucket), "left")
        position = F.bitmap_bit_position(value)
        byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        verdict = verdict & F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))
    return rows.select(*(F.col(f"`{c}`") for c in columns), verdict.alias(flag))


def _rank(n_points: str, key: str) -> Column:
    """Smallest for the row that stays."""
    return F.struct((-F.col(f"`{n_points}`")).alias("a"), F.col(f"`{key}`").isNull().alias("b"), F.col(f"`{key}`").alias("c"))


def duplicate_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``kept`` is true where a row's id is its group's ``keep_id``.
    """
    keys = stage(
        docs.select(
            F.col(f"`{key}`").alias("doc_id"), F.char_length(whole_text(text)).alias("n_points"), normal_digest(text).alias("text_sha256")
        ),
        "exact-digests",
    )
    bits = filter_bits(keys.count())
    flagged = flag_repeats(keys, "text_sha256", stage(repeat_filter(keys, "text_sha256", bits), "exact-filter"), bits, "maybe")
    maybe = stage(flagged.filter("maybe").drop("maybe"), "exact-maybe")
    groups = stage(
        maybe.groupBy("text_sha256").agg(F.min(_rank("n_points", "doc_id")).alias("best"), F.count("*").alias("group_size"))
        .select("text_sha256", F.col("best.c").alias("keep_id"), "group_size"),
        "exact-groups",
    )
    alone = flagged.filter(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    together = maybe.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
    return alone.unionByName(together)


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The input rows that stay, with all their columns; exactly one of each group of equal texts."""
    digest, n_points, flag = fresh(docs, "digest", "n_points", "maybe")
    columns = docs.columns
    digests = stage(docs.select(normal_digest(text).alias(digest)), "exact-digests")
    bits = filter_bits(digests.count())
    bitmaps = stage(repeat_filter(digests, digest, bits), "exact-filter")
    marked = docs.withColumns({digest: normal_digest(text), n_points: F.char_length(whole_text(text))})
    flagged = flag_repeats(marked, digest, bitmaps, bits, flag)
    whole = F.struct(*(F.col(f"`{c}`") for c in columns))
    winners = (
        flagged.filter(F.col(flag)).groupBy(digest).agg(F.min_by(whole, _rank(n_points, key)).alias("row"))
        .select(*(F.col("row").getField(c).alias(c) for c in columns))
    )
    alone = flagged.filter(~F.col(flag)).select(*(F.col(f"`{c}`") for c in columns))
    return alone.union(winners)
