"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewatch.session import materialise


#: Links below this number are one partition, and their steps need no shuffle.
SMALL_EDGES = 50_000


def _ends(first: str, second: str):
    return F.struct(F.col(first).alias("a"), F.col(second).alias("b"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node goes to the node's least neighbour, or to the node."""
    both = edges.select(F.inline(F.array(_ends("a", "b"), _ends("b", "a"))))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    far = both.where("b > a").join(least, "a")
    return far.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node, go to the least of them. ``a`` is the larger end."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(F.inline(F.array(_ends("b", "least"), _ends("a", "least"))))
    return moved.where("a <> b").distinct()


def _stored(edges: DataFrame) -> DataFrame:
    edges = materialise(edges.sparkSession, edges, "edges")
    return edges.coalesce(1) if edges.count() <= SMALL_EDGES else edges


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its least node) for all nodes of ``edges`` (a, b: any ordered type).

    Self-links, repeated links and links with a null end count for nothing, and an empty table has no nodes. A step aggregates and joins
    by node and is written to the shared folder; a hub's links are never gathered. The steps
    end when every node has one link, to a node without any: some log(n) of them."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = _stored(edges.distinct())
    while True:
        up = F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        down = F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        ends = edges.select(F.inline(F.array(up, down))).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.where("up > 1 or (up > 0 and down > 0)").isEmpty():
            break
        edges = _stored(_small_star(_large_star(edges)))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
