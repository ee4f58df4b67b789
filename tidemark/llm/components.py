"""Connected components as alternating star contractions of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

# Rounds after which something is wrong: the number of rounds is logarithmic in the longest path.
MOST_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or to itself)."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    larger = both.where(F.col("b") > F.col("a"))
    return larger.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    others = down.join(least, "a").where(F.col("b") != F.col("least"))
    return others.select(F.col("b").alias("a"), F.col("least").alias("b")).unionAll(
        least.select("a", F.col("least").alias("b"))
    )


def _settled(edges: DataFrame) -> bool:
    """Whether every edge leads from a node of no other edge to a node from which none leads: then ``b`` is the root."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down")).unionAll(edges.select("b", F.lit(0)))
    nodes = ends.groupBy("node").agg(F.count("*").alias("edges"), F.max("down").alias("down"))
    return nodes.where("down > 0 AND edges > 1").agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node of the edges ``a``, ``b`` that is no root.

    Nodes are longs; loops and repeated edges are allowed; no edges, no rows.
    Each round is two aggregations with map-side combining and two joins, whose
    hot side Spark splits; rounds are cut by a checkpoint in the shared folder.
    Edges that are stars already need no round. One row a round reaches the driver.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    edges = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct().checkpoint()
    for _ in range(MOST_ROUNDS):
        if _settled(edges):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = _small_star(_large_star(edges)).distinct().checkpoint()
    raise RuntimeError("components did not settle")
