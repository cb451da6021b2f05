"""Connected components by alternating large-star and small-star steps.

Kiveris, Lattanzi, Mirrokni, Rastogi, Vassilvitskii: Connected Components in MapReduce and Beyond,
SoCC 2014. The number of edges never grows and O(log^2 n) rounds suffice, also on long chains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.skew import spread_join
from plumbline.session import Checkpoints


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every node ties its greater neighbours to the least node around it."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    tied = spread_join(both.where("v > u"), least, ["u"])
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Every node ties itself and its smaller neighbours to the least of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    tied = spread_join(pairs, least, ["u"])
    ends = F.array(F.col("u"), F.col("v"))
    return tied.select(F.explode(ends).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _is_star_forest(pairs: DataFrame) -> bool:
    """Does each greater end have one edge, and is no smaller end a greater one elsewhere?"""
    ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")).unionByName(
        pairs.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in"))
    )
    nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return nodes.where("out > 1 or (out = 1 and in = 1)").isEmpty()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node on an edge; the component is named by its least node.

    Each round writes the edges to the checkpoint folder and drops what the round before wrote.
    """
    kept = Checkpoints(edges.sparkSession)
    whole = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    ordered = whole.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    # A node tied only to itself stays as an edge u = v: the stars leave it alone.
    start = kept.write(ordered.distinct())
    alone = start.where("u = v").select(F.col("u").alias("node"), F.col("v").alias("component"))
    pairs = start.where("u <> v")
    last = None
    while not _is_star_forest(pairs):
        pairs = kept.write(_small_star(_large_star(pairs)))
        if last is not None:
            kept.drop(last)
        last = pairs
    leaves = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centers = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    linked = leaves.unionByName(centers)
    return linked.unionByName(alone.join(linked.select("node"), "node", "left_anti"))
