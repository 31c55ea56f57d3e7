"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakflow.sources.staging import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links neighbours of a node to the smallest node known next to it.

    Minima are map-side aggregates and are joined back, so the neighbours of a node that many edges
    share are never gathered in one place; adaptive execution may split such a node in the join."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    # small: a is the larger end; large: every direction
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def _open(edges: DataFrame) -> bool:
    """Whether a node has two edges to smaller ones, or edges to a smaller and a larger one; if not, all edges are stars."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(edges.select("b", F.lit(0), F.lit(1)))
    per = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return per.where("down > 1 or (down > 0 and up > 0)").agg(F.count("*")).first()[0] > 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in `edges` (a, b): the smallest node reachable from it.

    Every step is written out, so a lost executor repeats one step at most. It ends when the edges are
    stars around the smallest nodes, after a number of steps that grows with the logarithm of the
    longest path; only counts reach the driver. Components found before go on as their stars, (node, component)."""
    oriented = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    current = stage(oriented, "edges")
    while _open(current):
        current = stage(_star(stage(_star(current, large=True), "large"), large=False), "small")
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionAll(roots)
