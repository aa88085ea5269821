"""Token counts by a map-side two-tier lookup.

Tier one is a compact table of the frequent units' token counts (a unit is a pre-token run with its
leading white space, see ``token_units``), broadcast to all tasks; tier two encodes what it misses
with the tokenizer and keeps the counts in a bounded cache of each Python worker. Texts and units
never cross the network.

The frequent units come from all texts: each task counts its units in a summary of bounded size
(once it is full, only the more frequent half is kept), and only these summaries, at most
``capacity`` rows a task, are added up. The table only saves work; counts are the library's own
whatever is in it.

Defined cases: a null text counts as empty and has 0 tokens; special strings inside a text are
treated as the library does by default; nothing is truncated; repeated rows are counted each;
extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import whole_text
from creditmart.llm.token_units import MAX_CACHED_UNIT, UnitCache, byte_counter, keyed_units, load, public_path
from creditmart.sources.stage import stage

TABLE_SIZE = 32_768
SUMMARY_SIZE = 65_536
CACHE_SIZE = 1_000_000


def summaries(capacity: int) -> Callable:
    """For mapInPandas over a text column: the frequent units of a task, with counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.iloc[:, 0]:
                counts.update(keyed_units(text) or ())
                if len(counts) > 6 * capacity:
                    counts = Counter(dict(heapq.nlargest(3 * capacity, counts.items(), key=lambda x: x[1])))
        top = [(u, n) for u, n in heapq.nlargest(capacity, counts.items(), key=lambda x: x[1]) if n > 1 and len(u) <= MAX_CACHED_UNIT]
        yield pd.DataFrame(top, columns=["unit", "n"])

    return run


def frequent_units(docs: DataFrame, text: str, table_size: int, summary_size: int) -> list[str]:
    """The units to broadcast: at most ``table_size``, most frequent first."""
    found = docs.select(whole_text(text).alias("text")).mapInPandas(summaries(summary_size), "unit string, n long")
    summed = stage(found.groupBy("unit").agg(F.sum("n").alias("n")), "token-units")
    # The driver reads a histogram (32 bins a power of two), then only the units above the bin where the table is full.
    bin_ = F.floor(F.log2("n") * 32)
    bins = summed.groupBy(bin_.alias("bin")).agg(F.count("*").alias("units")).collect()
    cut, held = None, 0
    for r in sorted(bins, key=lambda r: -r["bin"]):
        held += r["units"]
        if held > table_size:
            break
        cut = r["bin"]
    if cut is None:
        return []
    top = summed.filter(bin_ >= cut).collect()
    return [r["unit"] for r in sorted(top, key=lambda r: (-r["n"], r["unit"]))]


def counter(path: str, table, capacity: int) -> Callable:
    """For mapInPandas: adds ``n_tokens`` to batches with a text, and drops the text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = load(path)
        cache = UnitCache(byte_counter(tokenizer), table.value, capacity)

        def count(text: str) -> int:
            units = keyed_units(text)
            return len(tokenizer.encode(text, add_special_tokens=False)) if units is None else sum(map(cache.__getitem__, units))

        for batch in batches:
            yield batch.drop(columns="text").assign(n_tokens=[count(t) for t in batch["text"]])

    return run


def token_counts(
    docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 512, key: str = "doc_id", text: str = "text",
    table_size: int = TABLE_SIZE, summary_size: int = SUMMARY_SIZE, cache_size: int = CACHE_SIZE,
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit``. ``tokenizer`` is a file of the public tokenizers or a path."""
    path = tokenizer if "/" in tokenizer else public_path(tokenizer)
    spark = docs.sparkSession
    units = frequent_units(docs, text, table_size, summary_size)
    counts = map(byte_counter(load(path)), units)
    table = spark.sparkContext.broadcast(dict(zip(units, counts, strict=True)))
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.octet_length(whole_text(text)).cast("long").alias("n_bytes"), whole_text(text).alias("text"))
    # Pandas turns a long column with nulls into doubles; the id goes through as text.
    counted = rows.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        counter(path, table, cache_size), "doc_id string, n_bytes long, n_tokens long"
    )
    return counted.select(F.col("doc_id").cast("long").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
