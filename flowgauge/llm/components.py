"""Connected components of a distributed set of links, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import checkpointed, spread_join, stored


def components(links: DataFrame, most_rounds: int = 1000) -> DataFrame:
    """``node``, ``component``: the least node that it reaches. Links (``a``, ``b``) go both ways; nodes without links are absent.

    Every round links each node's greater neighbours, then its lesser ones, to its least neighbour (large star, small
    star), until nothing changes; the number of rounds grows with the logarithm of the nodes. Both steps are a minimum
    per node joined back to the links, the links of a node with many dealt over salts, so no node's neighbours are ever
    gathered in one task. Each step is written to the shared checkpoint folder. Null ends, self links and repeated links are ignored.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"), "a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = checkpointed(edges.select("u", "v").distinct())
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    before = (0, None)
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count_if(F.col("v") > F.col("u")).alias("n"))
        least = stored(least.select("u", F.least("u", "m").alias("m"), "n"))
        # Large star: neighbours greater than the node go to the least of node and neighbours.
        large = spread_join(both.filter("v > u"), least, ["u"], "n").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u <> v").distinct())
        # Small star: lesser neighbours and the node itself go to the least neighbour.
        small_least = stored(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        small = spread_join(large, small_least, ["u"], "n").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(small.unionByName(small_least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
