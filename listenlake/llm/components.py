"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.operators.durable import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Tie neighbours to the smallest neighbour: of every node (large), or of nodes that aren't larger.

    ``edges`` are (a, b) with a > b. The smallest neighbour is found by an aggregate that combines below
    the shuffle, and joined back, so that a hub never stands in one task.
    """
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = materialise(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "least")
    tied = both.join(least, "a")
    if large:
        return tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    linked = tied.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (two long columns a and b); root is the smallest reachable node.

    Each step keeps the components and is written before it is used; the work ends when a step changes
    nothing, after about the logarithm of the longest chain. Only counts reach the driver.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    now = materialise(now, "links")
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
        for large in (True, False):
            now = materialise(_star(now, large).where("a != b").distinct(), "star")
    roots = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    own = now.select(F.col("b").alias("node")).distinct().join(roots, "node", "left_anti")
    return roots.unionByName(own.withColumn("root", F.col("node")))
