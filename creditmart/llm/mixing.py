"""Mixing sources to target weights, in DataFrame operations.

1. Sizes (words per document) are summed per source; the driver shares out the targets.
2. Each source's words, in a fixed order of its documents, are packed into blocks of
   ``block_words``; a document's place comes from two-level prefix sums (hash buckets of bounded
   size inside a source), so no source is ordered in one task.
3. The output is a row of slots, cut into shards. Shard after shard draws its source counts from a
   multinomial over what every source still has to give, so the counts of a shard are random and
   those of the whole mix meet the targets.
4. The j-th slot of a source reads one block: position ``j mod blocks`` of that epoch's
   pseudorandom permutation of the block indices (swap-or-not rounds, a bijection on any size);
   a source's short last block ends each epoch. No block is taken an (e+1)-th time before all are
   taken e times.
5. Slots and document pieces meet by (source, block index).

The last slot of a source is cut, so that its taken words are its target to the word.

Targets: sources in code-point order, null last, weigh 1, 2, 3, 1, ...; they share 100 % of all
words by weight, no source gets more than ``cap`` times its size, and what is over is shared out
again by weight among those below. Defined cases: null or blank texts have size 0 and are taken 0
times; a source without words has target 0; an empty table gives an empty result; repeated rows
and ids are separate documents; extra columns are carried by ``mix_documents`` whatever their names.
Results do not depend on partitioning, except that rows equal in id, size and text may swap places.

Bounds: the driver holds one row per source (at most ``MAX_SOURCES``, else an error) and one draw
per shard and source (at most ``MAX_SHARDS`` shards: larger mixes get larger shards).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from creditmart.llm.common import WHITE_RUN, WORD, fresh, whole_text
from creditmart.sources.stage import stage

MAX_SOURCES = 10_000
MAX_SHARDS = 4_096
ROUNDS = 24
SLOTS_PER_TASK = 1 << 16


@dataclass(frozen=True)
class Mix:
    """Parameters of a mix."""

    block_words: int = 256
    shard_blocks: int = 4_096
    cap: int = 3
    seed: int = 7
    bucket_rows: int = 1_024


def word_count(text: str) -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


def weights(n: int) -> list[int]:
    return [1 + i % 3 for i in range(n)]


def share_out(sizes: list[int], weight: list[int], cap: int) -> list[float]:
    """Targets: the total by weight, none above ``cap`` times its size, the excess shared again."""
    total, fixed = float(sum(sizes)), [False] * len(sizes)
    target = [0.0] * len(sizes)
    while True:
        free = sum(w for w, f in zip(weight, fixed, strict=True) if not f)
        left = total - sum(t for t, f in zip(target, fixed, strict=True) if f)
        for i, f in enumerate(fixed):
            if not f:
                target[i] = left * weight[i] / free
        over = [i for i, f in enumerate(fixed) if not f and target[i] > cap * sizes[i]]
        if not over:
            return target
        for i in over:
            target[i], fixed[i] = float(cap * sizes[i]), True


def slots_for(size: int, target: float, block: int) -> tuple[int, int, int]:
    """Blocks of a source, its slots, and the words its last slot takes."""
    if size == 0:
        return 0, 0, 0
    blocks = -(-size // block)
    whole, rest = divmod(round(target), size)
    more = -(-rest // block)
    # Without a rest the last slot ends a full pass and takes its block whole.
    return blocks, whole * blocks + more, rest - (more - 1) * block if more else block


def draw(slots: np.ndarray, per_shard: int, seed: int) -> list[tuple[int, int, int, int]]:
    """(shard, source, first slot of that source, slots): multinomial counts shard by shard."""
    left, first, drawn, shard = slots.copy(), np.zeros_like(slots), [], 0
    random = np.random.Generator(np.random.PCG64(seed))
    while (remaining := int(left.sum())) > 0:
        want, got = min(per_shard, remaining), np.zeros_like(slots)
        while want:
            open_ = left - got
            got += np.minimum(random.multinomial(want, open_ / open_.sum()), open_)
            want = min(per_shard, remaining) - int(got.sum())
        drawn += [(shard, int(s), int(first[s]), int(got[s])) for s in np.flatnonzero(got)]
        first, left, shard = first + got, left - got, shard + 1
    return drawn


def permuted(index: Column, size: Column, key: Column) -> Column:
    """A pseudorandom permutation of 0 .. size-1: swap-or-not rounds, keyed by ``key``."""
    rounds = F.transform(F.sequence(F.lit(1), F.lit(ROUNDS)), lambda r: F.xxhash64(key, r))

    def swap(x: Column, k: Column) -> Column:
        other = F.pmod(k - x, size)
        return F.when(F.pmod(F.xxhash64(k, F.greatest(x, other)), F.lit(2)) == 1, other).otherwise(x)

    return F.aggregate(F.transform(rounds, lambda k: F.pmod(k, size)), index, swap)


def _placed(sized: DataFrame, mix: Mix) -> DataFrame:
    """``sized`` with ``start``: the words before the document in its source.

    A source has as many buckets as its rows need; a text's hash deals and orders rows that agree in id and size.
    """
    buckets = F.greatest(F.ceil(F.col("rows") / mix.bucket_rows), F.lit(1))
    dealt = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", "text_hash"), buckets))
    totals = dealt.groupBy("s", "bucket").agg(F.sum("size").alias("words"))
    before = totals.select(
        "s", "bucket", (F.sum("words").over(Window.partitionBy("s").orderBy("bucket")) - F.col("words")).alias("before")
    )
    inside = Window.partitionBy("s", "bucket").orderBy("doc_id", "size", "text_hash", "row")
    dealt = dealt.withColumn("within", F.sum("size").over(inside) - F.col("size"))
    return dealt.join(before, ["s", "bucket"]).withColumn("start", F.col("before") + F.col("within"))


def _pieces(sized: DataFrame, mix: Mix) -> tuple[DataFrame, DataFrame]:
    """The sources with targets, and per document and block: the words in it, and how often each is taken.

    Documents without words have one piece, of no block.
    """
    spark = sized.sparkSession
    found = sized.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("rows")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["n"] for r in found]
    targets = share_out(sizes, weights(len(found)), mix.cap)
    plan = [slots_for(n, t, mix.block_words) for n, t in zip(sizes, targets, strict=True)]
    sources = spark.createDataFrame(
        [(r["source"], i, r["n"], r["rows"], t, *p) for i, (r, t, p) in enumerate(zip(found, targets, plan, strict=True))],
        "source string, s int, source_size long, rows long, target double, blocks long, slots long, cut long",
    )
    counts = np.array([p[1] for p in plan], dtype=np.int64)
    per_shard = max(mix.shard_blocks, -(-int(counts.sum()) // MAX_SHARDS))
    draws = spark.createDataFrame(draw(counts, per_shard, mix.seed), "shard int, s int, first long, n long")
    parts = max(1, -(-int(counts.sum()) // SLOTS_PER_TASK))
    slots = (
        draws.repartition(parts, "shard", "s").join(F.broadcast(sources), "s")
        .select("s", "source_size", "blocks", "slots", "cut", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("j"))
    )
    key = F.xxhash64(F.lit(mix.seed), "s", F.floor(F.col("j") / F.col("blocks")))
    last = F.col("j") == F.col("slots") - 1
    place, full = F.col("j") % F.col("blocks"), F.floor(F.col("source_size") / mix.block_words)
    block = F.when(place < full, permuted(place, F.greatest(full, F.lit(1)), key)).otherwise(full)
    takes = (
        slots.withColumn("block", block)
        .groupBy("s", "block").agg(F.count_if(~last).alias("whole"), F.max(F.when(last, F.col("cut")).otherwise(0)).alias("partial"))
    )
    named = sized.join(F.broadcast(sources.select("source", "s", "rows")), sized["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    size = mix.block_words
    end = F.col("start") + F.col("size")
    blocks = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / size), F.floor((end - 1) / size)))
    pieces = (
        _placed(named, mix)
        .select("row", "doc_id", "size", "s", "start", F.explode(F.coalesce(blocks, F.array(-1 - F.col("row")))).alias("block"))
        .withColumn("low", F.when(F.col("size") > 0, F.greatest(F.col("start"), F.col("block") * size) - F.col("block") * size))
        .withColumn("high", F.when(F.col("size") > 0, F.least(end, (F.col("block") + 1) * size) - F.col("block") * size))
        .join(takes, ["s", "block"], "left")
        .na.fill(0, ["whole", "partial", "low", "high"])
    )
    return sources, pieces


def _sized(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("doc_id"),
        F.col(f"`{source}`").cast("string").alias("source"), word_count(text).alias("size"), F.xxhash64(whole_text(text)).alias("text_hash"),
    )


def mix_counts(docs: DataFrame, mix: Mix = Mix(), key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``."""
    sources, pieces = _pieces(stage(_sized(docs, key, text, source), "mix-sizes"), mix)
    words = F.col("high") - F.col("low")
    cut = F.greatest(F.lit(0), F.least(F.col("high"), F.col("partial")) - F.col("low"))
    return (
        pieces.groupBy("row", "doc_id", "size", "s").agg(F.sum(F.col("whole") * words + cut).alias("taken"))
        .join(F.broadcast(sources.select("s", "source_size", "target")), "s")
        .select("doc_id", "size", "source_size", "target", "taken")
    )


def mix_documents(docs: DataFrame, mix: Mix = Mix(), key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix as documents: the columns of ``docs``, one row for each time that words of a document are taken.

    Copy c of a document holds, in order, the words that the mix takes at least c times. A copy of all
    its words is the text as it was; otherwise the words are joined by single spaces, and a column
    ``n_chars`` is counted anew. Documents that no slot takes are not in the mix.
    """
    row, = fresh(docs, "mix_row")
    kept = stage(docs.withColumn(row, F.monotonically_increasing_id()), "mix-documents")
    sized = kept.select(
        F.col(row).alias("row"), F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
        word_count(text).alias("size"), F.xxhash64(whole_text(text)).alias("text_hash"),
    )
    _, pieces = _pieces(stage(sized, "mix-sizes"), mix)
    # Spans of words, counted from the document's start, with the number of times each is taken.
    base = F.col("block") * mix.block_words - F.col("start")
    edge = F.least(F.greatest(F.col("partial"), F.col("low")), F.col("high"))
    spans = (
        pieces.filter("size > 0")
        .select("row", "size", F.inline(F.array(
            F.struct((base + F.col("low")).alias("a"), (base + edge).alias("b"), (F.col("whole") + F.when(F.col("partial") > 0, 1).otherwise(0)).alias("n")),
            F.struct((base + edge).alias("a"), (base + F.col("high")).alias("b"), F.col("whole").alias("n")),
        )))
        .filter("b > a AND n > 0")
        .groupBy("row", "size").agg(F.sort_array(F.collect_list(F.struct("a", "b", "n"))).alias("spans"))
        .select("row", "size", "spans", F.explode(F.sequence(F.lit(1), F.array_max(F.transform("spans", lambda x: x["n"])).cast("int"))).alias("copy"))
        .select("row", "size", F.filter("spans", lambda x: x["n"] >= F.col("copy")).alias("spans"))
        .withColumn("taken", F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["b"] - x["a"]))
        .withColumn("spans", F.when(F.col("taken") < F.col("size"), F.col("spans")))
        .drop("size", "taken").withColumnsRenamed({"row": "mix_key", "spans": "mix_spans"})
    )
    mix_key, mix_spans = fresh(kept, "mix_key", "mix_spans")
    joined = kept.join(spans.withColumnsRenamed({"mix_key": mix_key, "mix_spans": mix_spans}), F.col(row) == F.col(mix_key))
    own, words = F.col(f"`{text}`"), F.filter(F.split(whole_text(text), WHITE_RUN), lambda w: w != "")
    cut = F.element_at(F.transform(F.array(words), lambda w: F.array_join(F.flatten(F.transform(
        F.col(mix_spans), lambda x: F.slice(w, (x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int")))), " ")), 1)
    changed = {text: F.when(F.col(mix_spans).isNull(), own).otherwise(cut)}
    out = joined.withColumns(changed)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType if isinstance(docs.schema["n_chars"].dataType, T.IntegralType) else T.LongType()
        out = out.withColumn("n_chars", F.when(F.col(mix_spans).isNull(), F.col("n_chars")).otherwise(F.char_length(own).cast(kind)))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))
