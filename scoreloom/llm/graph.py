"""Connected components by alternating stars, and joins with a checked broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.workspace import stored

BROADCAST_ROWS = 500_000


def sized(table: DataFrame, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table, marked for broadcast only while it is short; beyond that Spark shuffles both sides."""
    return F.broadcast(table) if table.count() <= most_rows else table


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); the label is the smallest node that is reachable.

    Large-star and small-star steps alternate until the edges stay the same, which takes a number of
    rounds that grows with the logarithm of the nodes. Minima are combined before the shuffle; the joins
    back to a node with many edges are plain equi-joins, which adaptive execution splits. Each round is
    a stored table, so a lost executor costs one round at most.
    """
    now = stored(edges.where(F.col("a") != F.col("b")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        now = stored(_small_star(_large_star(now)), "edges")
        after = _mark(now)
        if after == mark:
            break
        mark = after
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _with_least(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    return edges.join(least, "a")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _with_least(both).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    found = _with_least(down)
    pair: Column = F.explode(F.array(F.struct(F.col("a"), F.col("least")), F.struct(F.col("b").alias("a"), F.col("least"))))
    return found.select(pair.alias("p")).select(F.col("p.a").alias("a"), F.col("p.least").alias("b")).where(
        F.col("a") != F.col("b")).distinct()
