"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label: the smallest node of the component of every node that has an edge.

    Each round takes the least label among a node and its neighbours; from the third round on also the label of that label,
    so that long chains shrink by doubling. It ends when nothing changes. Rounds are checkpointed.
    """
    near = edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
    own = near.select("node").unionByName(near.select(F.col("other").alias("node"))).distinct()
    near = near.unionByName(near.select(F.col("other").alias("node"), F.col("node").alias("other"))).unionByName(
        own.select("node", F.col("node").alias("other"))).distinct().checkpoint()
    labels = near.groupBy("node").agg(F.min("other").alias("label")).checkpoint()
    rounds = 0
    while True:
        rounds += 1
        told = near.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(
            F.min("label").alias("label"), F.min(F.when(F.col("node") == F.col("other"), F.col("label"))).alias("before"))
        if rounds > 2:
            root = labels.select(F.col("node").alias("label"), F.col("label").alias("root"))
            told = told.join(root, "label").select("node", F.col("root").alias("label"), "before")
        told = told.checkpoint()
        labels = told.select("node", "label")
        if told.where("label < before").isEmpty():
            return labels
