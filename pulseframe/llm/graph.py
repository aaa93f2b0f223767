"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a minimum per node and a join; the minimum combines before its shuffle and the join is one that adaptive
execution can split, so a node with very many neighbours does not end in one task. Every round is written to shared
storage: nothing is kept on one executor and no edge goes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (or the not larger) neighbours of each node to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    linked = both.join(least, "a")
    if large:
        return linked.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b")
    own = least.filter("a <> least").select("a", F.col("least").alias("b"))
    return linked.select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b").unionByName(own)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node with an edge; edges are (a, b) of any orderable type, the least node names the component."""
    down = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = common.written(down.distinct(), name)
    marked = None
    while True:
        stepped = _star(_star(now, True).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), False)
        now = common.written(stepped.distinct(), name)
        total = now.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
        ).first()
        if marked == tuple(total):
            break
        marked = tuple(total)
    # stars now: every node points to its least
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
