"""Connected components of an edge table, by alternating star contractions; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them. Edges point from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges(a long, b long); root is the smallest node that it reaches.

    Self-edges and null ends are ignored. Rounds grow with the logarithm of the number of nodes; each round is
    written to the shared folder. Raises if max_rounds did not suffice, rather than return partial components.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = lambda df: tuple(
        df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )
    before = state(now)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        now = cut(_small_star(_large_star(now)))
        after = state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
