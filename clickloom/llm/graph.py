"""Distributed union-find over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import durable


def _toward_minimum(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One star round: neighbours of a node are linked to the least of them.

    The minimum is aggregated before it meets the edges again in a join, so a
    node with very many neighbours is combined map-side and its join partition
    can be split.
    """
    if larger_only:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("n"), F.least("a", "m").alias("m")
        )
        moved = both.join(least, F.col("a") == F.col("n")).where("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")
        )
    else:
        # here a > b in every row
        least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        moved = edges.join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.union(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).where("a <> b")
    return moved.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the least node reachable.

    Alternating large-star and small-star rounds, each written to the shared
    checkpoint folder, until the edges form stars; the number of rounds grows
    with the logarithm of the longest chain. Rows with a NULL end and loops say
    nothing and are ignored; a node that only such rows name is not returned.
    An empty table gives an empty result.
    """
    now = edges.where("a is not null and b is not null and a <> b")
    now = now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = durable(now)
    mark = None
    while True:
        large = _toward_minimum(now, larger_only=True)
        now = durable(_toward_minimum(large, larger_only=False))
        seen = now.agg(
            F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")
        ).first()
        if mark == (seen.n, seen.x):
            break
        mark = (seen.n, seen.x)
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
