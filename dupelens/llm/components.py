"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dupelens.llm.tables import keep


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("root"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("root"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return moved.union(least.select("a", F.col("root").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(a, root)`` for every node of ``links (a, b)`` but the roots, which are the least of their component.

    Each round is written to the shared folder. Nodes with very many links are only ever combined by a minimum
    before the shuffle, or stand on one side of a join that can be split.
    """
    edges = keep(_small_star(links.where("a <> b")), "stars")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return edges.select("a", F.col("b").alias("root"))
        before = state
        edges = keep(_small_star(_large_star(edges)), "stars")
