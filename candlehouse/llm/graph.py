"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlehouse.llm.common import checkpoint


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b: bigint): the smallest node that each can reach.

    Every round takes the smallest label around each node and then the label of that label, so labels travel twice as far each
    time. Edges and labels live in the shared folder between rounds; only whether anything changed comes to the driver.
    """
    edges = checkpoint(edges.select("a", "b"))
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = checkpoint(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component")))
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "component"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        nearer = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("via"))
        far = labels.select(F.col("node").alias("via"), F.col("component").alias("far"))
        new = checkpoint(nearer.join(far, "via").select("node", "old", F.least("via", "far").alias("component")))
        labels = new.select("node", "component")
        if new.where(F.col("old") != F.col("component")).isEmpty():
            return labels


def merged(first: DataFrame, edges: DataFrame) -> DataFrame:
    """Components of the graph of which ``first`` has some already, with more ``edges``: only edges between them are followed."""
    to = lambda s: first.select(F.col("node").alias(s), F.col("component").alias(f"c{s}"))
    between = (edges.join(to("a"), "a", "left").join(to("b"), "b", "left")
               .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b").distinct())
    second = components(between)
    moved = (first.join(second.select(F.col("node").alias("component"), F.col("component").alias("c")), "component", "left")
             .select("node", F.coalesce("c", "component").alias("component")))
    return moved.unionAll(second.join(first, "node", "left_anti").select("node", "component"))
