"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import staged


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the label is the smallest node reachable.

    Alternates the large-star and small-star steps: every node hands its smallest neighbour to the
    others, first upwards, then downwards, until the edges are stars around the smallest nodes. Steps
    are grouped minima and joins, so a node of very high degree is pre-aggregated and its join can
    be split. Each round is written to the shared folder. Loops and repeated edges do no harm; an
    empty table gives an empty one.
    """
    current = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", drop=True)
    mark = _mark(current)
    for _ in range(rounds):
        if not mark[0]:
            break
        current = staged(_small_star(_large_star(current)), "edges", drop=True)
        before, mark = mark, _mark(current)
        if before == mark:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _mark(edges: DataFrame) -> tuple[int, str]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
    return row["n"], str(row["s"])


def _large_star(edges: DataFrame) -> DataFrame:
    # Every edge points from the larger node to a smaller one, and gives one edge; repeated ones are left for the small star.
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return edges.join(least.select(F.col("a").alias("b"), "m"), "b").select("a", F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    # The edge to the smallest neighbour stays, the ends of the others turn to it.
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()
