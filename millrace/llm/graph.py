"""Connected components of a graph held in a frame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every end of the edges (a, b): the smallest node that it is connected with.

    Each round takes the smallest label among a node's neighbours, then the label of
    that label, and ends when no label has changed. A hub's edges are dealt by their
    other ends or reduced before the shuffle. Labels are staged every round.
    """
    both = staged(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).select(F.col("a").alias("node"), "label")
        lower = near.union(labels).groupBy("node").agg(F.min("label").alias("label"))
        onward = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = lower.join(onward, "label", "left").select("node", F.least("label", "next").alias("label"))
        before = labels.withColumnRenamed("label", "before")
        new = staged(jumped.join(before, "node"), "labels")
        labels = new.select("node", "label")
        if new.where("label <> before").isEmpty():
            return labels
