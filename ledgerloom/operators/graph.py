"""Connected components with joins and aggregates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ledgerloom.context import checkpointed
from ledgerloom.sources.build import build_table


def _digest(edges: DataFrame) -> Row:
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame, most_rounds: int = 80) -> DataFrame:
    """``v, root``: every vertex of ``links`` (a, b, of one type that has an order) with the least vertex that it reaches.

    Each round hangs a vertex's larger neighbours on its least one, then the smaller ones. The number of links never grows, and
    rounds grow with the logarithm of the longest path. Minima are combined before they are shuffled and written before they
    are joined, so a vertex with very many links is split by adaptive execution. Two numbers a round reach the driver.

    Links are written as a table each round: a checkpoint keeps the size Spark estimated for it, a join's estimate is the product of both
    sides', so the digits of that number would grow fourfold with each round, and planning with them."""
    clean = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = build_table(clean.distinct(), "links")
    before = _digest(edges)   # links that already are stars settle in one round
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = checkpointed(both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m")))
        large = checkpointed(both.join(least, "a").where("b > a AND b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct())
        lower = checkpointed(large.groupBy("a").agg(F.min("b").alias("_m")))
        small = large.join(lower, "a").where("b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        edges = build_table(small.unionByName(lower.withColumnRenamed("_m", "b")).distinct(), "links")
        now = _digest(edges)
        if now == before:
            return edges.select(F.col("a").alias("v"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("v"), F.col("b").alias("root")).distinct())
        before = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
