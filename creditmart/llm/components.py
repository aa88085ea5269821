"""Connected components of an edge table, by smallest-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.sources.stage import stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (the smallest node reached) for every node that has an edge.

    Every round takes the smallest label among the neighbours, then follows the label's own label, so
    long chains shorten geometrically. Labels are written to the shared folder each round; only the
    number of labels that changed comes to the driver. A node with very many neighbours is reduced
    map-side, and adaptive execution splits it in the join of two staged tables.
    """
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).union(edges.select(F.col(b), F.col(a)))
    both = stage(both.filter("node <> other").distinct(), "component-edges")
    labels = stage(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("component")), "component-labels")
    while True:
        near = both.join(labels.withColumnsRenamed({"node": "from"}), F.col("other") == F.col("from")).groupBy("node").agg(F.min("component").alias("m"))
        lower = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "m").alias("component"))
        lower = stage(lower, "component-lower")
        top = lower.select(F.col("node").alias("via"), F.col("component").alias("via_component"))
        after = stage(
            lower.join(top, F.col("component") == F.col("via"), "left")
            .select("node", "old", F.least("component", F.coalesce("via_component", "component")).alias("component")),
            "component-labels",
        )
        labels = after.select("node", "component")
        if not after.filter("old <> component").limit(1).count():
            return labels
