"""The training-data pipeline: documents in, packed token sequences out.

Each stage takes what its predecessor kept, written as Parquet and read again, and returns documents;
the last returns the pieces of the sequences. Every stage handles its own empty, null, repeated and very
long rows as its operator's module states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creditmart.llm import exact_dedup, mixing, ngram_join, packing, quality_knn
from creditmart.llm.common import read, ship
from creditmart.sources.stage import stage


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest-neighbour classifier rejects go. It is fitted on the labelled documents among the input."""
    ship(spark)
    return quality_knn.keep_good(docs, quality_knn.fit(docs, read(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the longest stays, then the one with the smallest id."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the one with the smallest id stays."""
    ship(spark)
    return ngram_join.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words of each source meet its target: documents are cut or repeated."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece of a document."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("quality classifier", drop_low_quality),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: The classifier, MinHash, the draws and the packing cannot be expressed in SQL; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
