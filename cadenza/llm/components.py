"""Connected components of a graph given as edges, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import dropped, stored


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of all nodes on an edge (a, b).

    Each round every node takes the smallest label among its neighbours, then the label of its
    label, so chains shorten by halves. Minima are combined before the shuffle; a node with very
    many edges is no single task's. Rounds end when no label changes.
    """
    both = stored(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges"
    )
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
            "node", F.least("node", "least").alias("component")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        closer = labels.join(near, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("closer")
        )
        hop = labels.select(F.col("node").alias("closer"), F.col("component").alias("further"))
        after = stored(
            closer.join(hop, "closer").select(
                "node", "before", F.least("closer", "further").alias("component")
            ),
            "labels",
        )
        changed = after.where("before <> component").limit(1).count()
        dropped(labels)
        labels = after.select("node", "component")
        if not changed:
            dropped(both)
            return labels
