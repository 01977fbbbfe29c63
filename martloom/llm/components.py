"""Connected components of a graph that is larger than any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of each node to the smallest of them: the larger neighbours, or the smaller ones and itself.

    ``edges`` holds ``a > b``. The minimum is a count before the shuffle, and the join has plain scans on both
    sides, so a node with very many neighbours is split.
    """
    if large:
        out = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        near = out.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    smallest = materialize(near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-min")
    linked = near.join(smallest.hint("merge"), "u")
    if large:
        moved = linked.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = linked.select(F.col("v").alias("a"), F.col("m").alias("b"))
        moved = moved.union(smallest.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.filter("a > b").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether each node has one smaller neighbour, or only larger ones."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    counted = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counted.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """From undirected ``a, b`` (longs): ``node, component`` (its smallest node) for each node that is not the
    smallest of its component. Alternates large and small stars until only stars are left; the rounds
    grow with the logarithm of the longest path."""
    current = materialize(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges"
    )
    while not _stars(current):
        current = materialize(_star(materialize(_star(current, True), "cc-large"), False), "cc-edges")
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
