"""Connected components of a graph given as an edge table, by star contraction.

Large-star and small-star rounds alternate until the edges form stars around the
least node of every component. Each round is two aggregations and joins on a node,
never a list of a node's neighbours, so a node with very many edges costs partial
aggregates only. Every round is written to the shared folder; one partial aggregate tells
whether stars are reached, so no round is spent on finding that nothing changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin, unpin


def _hooked(directed: DataFrame, least: DataFrame) -> DataFrame:
    """Edges (v, m(u)) of the directed edges (u, v), with m given by ``least`` (n, m)."""
    return directed.join(least, F.col("u") == F.col("n")).select(F.col("v").alias("a"), F.col("m").alias("b"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")).select("n", F.least("n", "m").alias("m"))
    # One row for each edge; the small star makes them distinct.
    return _hooked(both.where("v > u"), least)


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
    linked = _hooked(down, least).where("a <> b")
    return linked.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of ``edges`` (a > b) either has one edge to a lesser node, or only edges to greater ones."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up = 1 and down = 1)").agg(F.count("*")).first()[0] == 0


def component_roots(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of its component for every node of ``edges`` (a, b).

    Nodes without an edge to another node are not returned.
    """
    edges = pin(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _are_stars(edges):
        before, edges = edges, pin(_small_star(_large_star(edges)))
        unpin(before)
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
