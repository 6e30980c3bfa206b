"""Connected components by label propagation with pointer jumping, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node it is linked with) for every node of the edges (a, b).

    Every round lowers a node's label to the least of its neighbours' labels, then to its label's
    own label, which halves the distance to go. Minima are combined before every shuffle, so a
    node with very many links is no hot group. The labels of a round are stored.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(),
                  "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.first("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy(both["a"].alias("node"))
                .agg(F.min("component").alias("near")))
        lower = labels.join(near, "node").select(
            "node", F.col("component").alias("old"),
            F.least("component", "near").alias("component"))
        root = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
        after = stored(lower.join(root, "component", "left").select(
            "node", "old", F.least("component", F.coalesce("root", "component"))
            .alias("component")), "labels")
        labels = after.select("node", "component")
        if after.filter(F.col("old") != F.col("component")).isEmpty():
            return labels
