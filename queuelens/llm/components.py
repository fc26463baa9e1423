"""Connected components of a distributed edge list by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelens.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) of longs -> (node, root): root is the smallest node of the component; only nodes with edges.

    Large-star hooks every larger neighbour of a node to the node's smallest
    neighbour, small-star every smaller one; both keep connectivity and the
    number of rounds grows with the logarithm of the longest chain.  Each round
    is written to the shared folder, and only a checksum reaches the driver.
    """
    def both(e):
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))

    def least(e, v):
        return e.groupBy("u").agg(F.least("u", F.min(v)).alias("m"))

    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        check = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if check == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct())
        seen = check
        two = both(edges)
        large = two.join(least(two, "v"), "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), "large_star")
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        m = least(down, "v")
        small = down.join(m, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(m.select("u", "m"))
        edges = written(small.distinct(), "small_star")
