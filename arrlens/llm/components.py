"""Connected components of link tables, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is tied to the least neighbour."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and itself, are tied to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    rest = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """From links (a, b): (node, component) of every node with a link, the
    component being its least node. Hot nodes cost no more than others: their
    edges are reduced before they are exchanged, and joins split them."""
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                   "links")
    # Until all edges lead to a node that leads nowhere: the stars are complete.
    while not (edges.join(edges.select(F.col("a").alias("b")).distinct(), "b", "left_semi").isEmpty() and
               edges.groupBy("a").count().where("count > 1").isEmpty()):
        if rounds == 0:
            raise RuntimeError("the components' rounds ran out before the stars were complete")
        rounds -= 1
        new = stored(_small_star(_large_star(edges)), "links")
        discard(edges)
        edges = new
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct())
