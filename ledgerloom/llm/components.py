"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Each step links nodes to the smallest node that they or a neighbour see, so chains shorten by a
    factor in each round; a round ends in a written table.  Loops and repeated edges do no harm.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    pairs = written(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        # large star: every larger neighbour is linked to the least of the neighbourhood
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: a node's smaller neighbours and itself are linked to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).groupBy("node").agg(F.min("component").alias("component"))
