"""Connected components of an undirected edge table, by alternating large-star and small-star steps.

Each step is a minimum per node (combined before the shuffle, so a node with a third of all edges is one
row per task) and an equi-join back; the edges of each round are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import forget, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = written(least, "least")
    joined = both.join(least, "u")
    if large:                       # neighbours above u hang on u's least neighbour
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:                           # neighbours up to u, and u itself, hang on it
        out = joined.where("v < u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.where("m < u").select("u", F.col("m").alias("v")))
    out = written(out.where("u != v").distinct(), "edges")
    forget(least, edges)
    return out


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """``(node, component)`` for every node that stands in an edge; component is its least node.

    Loops and repeated edges do not matter; an empty edge table gives an empty result."""
    now = written(edges.select(F.least(u, v).alias("v"), F.greatest(u, v).alias("u"))
                  .where("u != v").distinct(), "edges")

    def state(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    after = state(now)
    while True:
        before, now = after, _star(_star(now, large=True), large=False)
        after = state(now)
        if after == before:                     # stars already: nothing moved
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
