"""Connected components of an undirected graph, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentalytics.llm.common import keep


def components(edges: DataFrame) -> DataFrame:
    """node, label (the least node of its component) for the nodes of ``edges`` (a, b).

    Each round takes the least label among a node's neighbours and then the label of that label, so labels travel
    twice as far every round; each round's table is written, and rounds end when no label changes.
    """
    both = keep(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "cc-edges")
    labels = keep(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                  .select("node", F.least("node", "b").alias("label")), "cc-labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        met = labels.join(near, labels.node == near.a).select("node", F.col("label").alias("old"), F.least("label", "near").alias("met"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("far"))
        step = keep(met.join(jump, F.col("met") == F.col("to"), "left")
                    .select("node", "old", F.least("met", "far").alias("label")), "cc-labels")
        labels = step.select("node", "label")
        if step.where("label <> old").isEmpty():
            return labels
