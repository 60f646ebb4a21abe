"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxweave.llm import common


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns a, b): the smallest node reachable.

    Each round hangs the larger neighbours of every node on its smallest neighbour, then the smaller
    ones.  It ends when a round changes nothing; the number of rounds grows with the logarithm of the
    longest path.  Every round is written to the shared folder.  A node with very many links only sends and
    gets one row for each link, and the smallest neighbour is found by an aggregate combined before the shuffle.
    """
    edges = common.stored(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    mark = _mark(edges)
    while True:
        edges = common.stored(_small_star(_large_star(edges)), "stars")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = both.where(F.col("v") > F.col("u")).join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    smaller = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return smaller.union(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(38,0)"))).first())
