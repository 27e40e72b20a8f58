"""Connected components of a link table, by alternating large and small stars.

Every step is a grouped minimum and a join on one node column; nothing goes to
the driver but a count and a checksum a round. Stars around a hot node are
summed before the shuffle, and Spark can split the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlark.llm._shared import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
    up = both.where("b > a").join(least, F.col("a") == F.col("c"))
    return up.where("m <> b").select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # an edge is (a, b) with a < b: b's smaller neighbours
    least = edges.groupBy("b").agg(F.min("a").alias("m")).select(F.col("b").alias("c"), "m")
    down = edges.join(least, F.col("b") == F.col("c"))
    linked = down.where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return linked.union(least.select(F.col("m").alias("a"), F.col("c").alias("b"))).distinct()


def connect(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every linked node; component is the smallest node reachable. links: (a, b), a < b."""
    edges, seen = scratch.save(links.select("a", "b").distinct()), None
    while True:
        mark = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if mark["n"] == 0 or mark == seen:
            break
        seen = mark
        after = scratch.save(_small_star(_large_star(edges)))
        scratch.drop(edges)
        edges = after
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
