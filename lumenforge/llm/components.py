"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenforge.llm.shared import removed, written


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """edges (a, b) of longs as node, component (its smallest node); nodes without an edge to another node are left out.

    Each half round hangs a node's neighbours on the smallest of them, by an aggregate and a join on the node; a node of very
    many neighbours is one join key, which adaptive execution splits. The rounds grow with the logarithm of the longest
    path; edges that have not settled after `rounds` of them are an error, never a wrong answer.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # large star: neighbours above a node go to its least neighbour
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # small star: a node and its neighbours below go to the least of those
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        last, now = now, written(small, "edges")
        removed(last)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
