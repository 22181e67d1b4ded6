"""Connected components of a graph that may hold hot nodes, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v, m) of symmetric edges: m is the least of u and its neighbours.

    The aggregate has one row per node and task before the shuffle; the join streams
    the edges, so that those of a hot node can be split.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return edges.join(least.withColumnRenamed("u", "n"), F.col("u") == F.col("n")).select("u", "v", "m")


def _unfinished(edges: DataFrame) -> DataFrame:
    """Nodes with two lower neighbours, or with a lower and a higher one: none where all edges form stars around least nodes."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above"))
    )
    sums = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return sums.where("below > 1 OR below = 1 AND above = 1")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every node of `edges` (columns a, b); component is the least node.

    Alternates the large-star and small-star steps: each links neighbours to the least
    node around, keeps components as they are and ends with one star per component,
    after a number of rounds that grows with the logarithm of the size. Every round
    is written to the shared folder. Loops and repeated edges are harmless; without
    edges there are no rows.
    """
    now = scratch.keep(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    while not _unfinished(now).isEmpty():
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: the neighbours above a node go to the least node around it.
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: a node and its lower neighbours go to the least of them.
        low = _with_least(large.where("u <> v").distinct())
        small = low.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        after = scratch.keep(small.where("u <> v").distinct())
        scratch.free(now)
        now = after
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
