"""Connected components of an edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.session import written

MOST_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node's smaller neighbours, and itself, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (
        down.join(least, "a")
        .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        .select(F.col("e.a").alias("a"), F.col("e.m").alias("b"))
        .where("a <> b")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) of comparable ids: (a, b) with b the smallest id of a's component, for a <> b.

    Ids that are the smallest of their component, or have no edge to another id, are not listed.  Loops and
    repeated edges are allowed; rows with a null end are dropped.  Each round writes its edges to the shared
    folder; the number of rounds grows with the logarithm of the longest path.
    """
    now = written(edges.select("a", "b").where("a <> b").distinct())
    mark = None
    for _ in range(MOST_ROUNDS):
        now = written(_small_star(_large_star(now)))
        last, mark = mark, now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if mark == last or mark[0] == 0:
            return now
    raise RuntimeError(f"components not settled after {MOST_ROUNDS} rounds")
