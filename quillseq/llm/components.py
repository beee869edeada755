"""Connected components of links between nodes, by min-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillseq.llm.common import discard, settle, tidy


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and label (the smallest node of its component) of every node that has a link.

    Each round takes the smallest label among a node, its neighbours and its label's label, so rounds grow with the
    logarithm of a component's width. A node with many links is combined before the shuffle; joins are plain equi-joins,
    whose skewed partitions Spark splits."""
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    both = settle(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "both-ways", small=True)
    labels = settle(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.min("x")).alias("label")), "labels", small=True)
    while True:
        near = both.join(labels, both["y"] == labels["node"]).groupBy(F.col("x").alias("n")).agg(F.min("label").alias("near"))
        one = labels.join(near, labels["node"] == near["n"]).select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        jump = labels.select(F.col("node").alias("l"), F.col("label").alias("far"))
        new = settle(one.join(jump, one["label"] == jump["l"], "left").select("node", "was", F.least("label", F.coalesce("far", "label")).alias("label")), "labels", small=True)
        discard(labels)
        labels = new
        tidy(links.sparkSession)
        if not new.where("label <> was").limit(1).count():
            discard(both)
            return labels.select("node", "label")
