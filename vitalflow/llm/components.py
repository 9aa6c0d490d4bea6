"""Connected components of an edge list by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: the neighbours of a node are linked to the smallest of them and the node.

    Large: for each node, its larger neighbours. Small: its smaller ones and the node itself.
    The smallest comes from an aggregation and goes back to the edges by a join, so a node with
    very many neighbours is never gathered in one task.
    """
    near = _both(edges) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    least = near.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
    linked = near.join(least, near["a"] == least["node"])
    if large:
        out = linked.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("node").alias("a"), F.col("m").alias("b"))
        )
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b of one orderable type. node, root for every node with an edge.

    root is the smallest node of the component. Each round is written to the shared folder.
    The loop ends when every edge leads to a root and no root has an edge onward.
    """
    now = materialise(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    while True:
        now = materialise(_star(_star(now, True), False), "edges")
        # after a small star every edge leads down from a to b; done when no b is an a as well
        # and no a has two b
        many = now.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1)
        onward = now.select("b").join(now.select(F.col("a").alias("b")), "b", "left_semi").limit(1)
        if not many.union(onward.select(F.col("b"), F.lit(0))).take(1):
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
