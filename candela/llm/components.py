"""Connected components of a distributed edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import stored


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a long, b long) -> (node long, root long): root is the smallest node reachable. Nodes without an
    edge to another node are not listed.

    Each round hangs every node's larger neighbours on its smallest neighbour (large star), then its smaller ones
    (small star), until nothing changes; no node's neighbours are ever gathered in one place (a minimum per node,
    joined back; AQE splits a hub's rows). Every round is written to the shared folder.
    """
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    last = None
    for _ in range(max_rounds):
        edges = stored(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        last = now
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    """(a, b) with a < b in and out."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    far = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("m").alias("a"), "b")
    return far.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m")).select(F.col("b").alias("u"), "m")
    near = edges.join(least, F.col("b") == F.col("u")).select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y"))
    return near.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
