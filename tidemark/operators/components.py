"""Connected components by smallest labels, with lineage cut in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import checkpointed

def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component): component is the smallest node that can be reached; any orderable type of node.

    nodes: node; edges: a, b in either direction. Edges with unknown ends are ignored; an isolated node is its own. Labels
    only fall and also jump, so rounds come to an end and grow with the log of the diameter.
    """
    both = checkpointed(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    nodes = nodes.select("node").distinct()
    # rounds go over nodes with an edge only
    labels = checkpointed(nodes.join(both.select(F.col("a").alias("node")).distinct(), "node", "left_semi").withColumn("component", F.col("node")))
    while True:
        told = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(told, "node", "left").select("node", "component", F.least("component", "near").alias("next"))
        jump = lower.select(F.col("node").alias("next"), F.col("next").alias("after"))
        moved = checkpointed(lower.join(jump, "next", "left").select("node", "component", F.least("next", "after").alias("next")))
        changed = moved.filter(F.col("next") != F.col("component")).limit(1).count()
        labels = moved.select("node", F.col("next").alias("component"))
        if not changed:
            return nodes.join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
