"""Connected components of a graph given as edges, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from couponlens.llm.common import stored


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("child", "parent"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("parent").alias("child"), F.col("child").alias("parent"))).toDF("node", "other")
    least = stored(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least")), "least")
    # Larger neighbours alone are moved, so an edge is met once, from its parent.
    return (edges.join(least.withColumnRenamed("node", "parent"), "parent")
            .select("child", F.col("least").alias("parent")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = stored(edges.groupBy("child").agg(F.min("parent").alias("least")), "least")
    moved = edges.join(least, "child").where("parent != least").select(F.col("parent").alias("child"), F.col("least").alias("parent"))
    return moved.unionByName(least.select("child", F.col("least").alias("parent"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (two columns); the root is the smallest node reachable.

    Each round hangs larger neighbours under the smallest one (large star),
    then smaller neighbours likewise (small star), until every component is a
    star: O(log n) rounds in practice. Edges stay distributed and are stored
    after each half round; only a count and a checksum reach the driver. The
    smallest neighbours are stored before they are joined, so that both sides
    of the join are plain shuffles and AQE can split a node that a large part
    of all edges meet. Self-loops and repeated edges are allowed.
    """
    a, b = edges.columns
    now = stored(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("child"), F.least(a, b).alias("parent")).distinct(), "edges")
    before = None
    while (signature := _signature(now)) != before:
        before = signature
        now = stored(_small_star(stored(_large_star(now), "edges")), "edges")
    roots = now.select(F.col("parent").alias("node"), F.col("parent").alias("root")).distinct()
    return now.select(F.col("child").alias("node"), F.col("parent").alias("root")).unionByName(roots)
