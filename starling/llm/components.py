"""Connected components of a graph that no single task could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v")))


def _tangled(edges: DataFrame) -> int:
    """How many nodes keep the edges from being stars: tied to several, or tied while others are tied to them."""
    ends = F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    )
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).count()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of an edge other than its component's smallest node.

    ``edges`` has two columns of integers. Large stars and small stars alternate until every edge
    leads to the smallest node; that takes a logarithmic number of rounds. Each round's edges are
    written to the shared folder, and one number a round comes to the driver. Edges lead down, so
    they are done when each node is tied to one that is tied to no other; no round is spent on
    finding that nothing changes.
    """
    a, b = edges.columns
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    now = stored(pairs.distinct(), "edges")
    while _tangled(now):
        large = stored(_large_star(now).distinct(), "edges")
        now = stored(_small_star(large).where("u <> v").distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
