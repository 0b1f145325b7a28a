"""Connected components of a stored edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the smallest node that
    its edges reach.

    Each round a node takes the smallest label around it and then that label's
    own label, so labels travel twice as far every round. Joins are on nodes;
    a node with very many edges is a skewed join key that adaptive execution
    splits, and its minimum is taken partly before the shuffle.
    """
    both = stored(edges.select("a", "b").where(F.col("a") != F.col("b"))
                  .union(edges.select("b", "a").where(F.col("a") != F.col("b"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        around = (both.join(labels, both["b"] == labels["node"])
                  .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        nearer = labels.join(around, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = nearer.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = stored(nearer.join(jump, "label").select(
            "node", "was", F.least("label", "next").alias("label")), "labels")
        settled = new.where(F.col("was") != F.col("label")).isEmpty()
        labels = new.select("node", "label")
        if settled:
            return labels
