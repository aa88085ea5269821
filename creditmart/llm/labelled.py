"""A bounded sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import held_out, whole_text


def training_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``text, label``: at most ``limit`` labelled ids outside the test fold, picked by a hash of the id.

    Null labels are ignored; where an id has several labels, the mean decides (half counts as 1).
    The sample's ids are broadcast, which the limit bounds; texts are not shuffled.
    """
    name = F.col(f"`{key}`").alias("label_key")
    known = labels.filter(F.col(f"`{label}`").isNotNull() & F.col(f"`{key}`").isNotNull() & ~held_out(key))
    one = known.groupBy(name).agg((F.avg(F.col(f"`{label}`").cast("double")) >= 0.5).cast("int").alias("label"))
    picked = one.orderBy(F.xxhash64("label_key"), "label_key").limit(limit)
    texts = docs.select(F.col(f"`{key}`").alias("text_key"), whole_text(text).alias("text"))
    return texts.join(F.broadcast(picked), F.col("text_key") == F.col("label_key")).select("text", "label")
