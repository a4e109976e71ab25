"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cluster import settle


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(v, label): for each node the smallest node it is connected to.

    nodes: v; edges: a, b, in any direction, repeats and loops allowed. Labels are lowered to the smallest of the neighbours' and then
    to the label of the label, until none changes; each round is written to the shared folder. Labels only fall and there are finitely
    many, so the rounds end. A node with many neighbours is a hot key of the join: adaptive execution splits it, and the minimum is
    taken within tasks first.
    """
    both = settle(edges.where("a <> b").select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges", free=False)
    if both.isEmpty():
        return nodes.select("v", F.col("v").alias("label"))
    # only nodes with edges take part in the rounds
    labels = settle(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels", free=False)
    while True:
        near = both.join(labels.withColumnRenamed("v", "b"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        lowered = labels.join(near, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("v").alias("label"), F.col("label").alias("up"))
        new = settle(lowered.join(up, "label", "left").select("v", "old", F.least("label", F.coalesce("up", "label")).alias("label")), "labels", free=False)
        labels = new.select("v", "label")
        if new.where("old <> label").isEmpty():
            return nodes.select("v").join(labels, "v", "left").select("v", F.coalesce("label", "v").alias("label"))
