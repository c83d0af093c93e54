"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threadline.plans.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node with an edge other than a root; the root is the smallest node.

    ``edges`` has long columns u and v. Each round hangs the neighbours of a
    node under its smallest one; the number of rounds grows with the logarithm
    of the longest chain, and only numbers of nodes are moved.
    """
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, before = scratch.save(pairs, "edges"), None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.unionByName(now.join(least, "u").select("u", F.col("m").alias("v")).where("u <> v")).distinct()
        large = scratch.save(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        old, now = now, scratch.save(small, "edges")
        scratch.discard(old)
        scratch.discard(large)
