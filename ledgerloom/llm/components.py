"""Connected components of links that stay distributed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) as links (vertex, least vertex of its component); what is its own least is left out."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = np.arange(len(names))
    x, y = ends[:len(a)], ends[len(a):]
    while True:
        px, py = parent[x], parent[y]
        open_ = px != py
        if not open_.any():
            break
        x, y, px, py = x[open_], y[open_], px[open_], py[open_]
        np.minimum.at(parent, np.maximum(px, py), np.minimum(px, py))
        while (parent[parent] != parent).any():
            parent = parent[parent]
    child = np.flatnonzero(parent != np.arange(len(names)))
    return names[child], names[parent[child]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each run of batches down to a forest: never more links than vertices go on."""
    a = b = np.empty(0, np.int64)

    def out() -> pa.RecordBatch:
        x, y = forest(a, b)
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])
    for batch in batches:
        a, b = np.concatenate([a, batch.column(0).to_numpy()]), np.concatenate([b, batch.column(1).to_numpy()])
        if len(a) > 1_000_000:
            yield out()
            a = b = np.empty(0, np.int64)
    if len(a):
        yield out()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``v, root``: every vertex of ``links`` (a, b, two longs) with the least vertex that it reaches.

    Links are first contracted inside their partitions, then large-star and small-star steps alternate until nothing
    changes, about log(longest path) rounds. A step hangs a vertex's neighbours on the least of them: minima are
    combined before they are shuffled, a vertex of many links meets its minimum in a join whose large partitions
    adaptive execution splits, and each round starts from a written table. Nothing is collected but two sums."""
    clean = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.col("a").cast("bigint"), F.col("b").cast("bigint"))
    edges = stored(clean.mapInArrow(_contract, "a bigint, b bigint"), "links")
    before = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written, so that the join shuffles both sides anew and a vertex of very many links can be split
        least = stored(both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m")), "least")
        large = both.join(least, "a").where("b > a AND b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()
        large = stored(large, "links")
        lower = stored(large.groupBy("a").agg(F.min("b").alias("_m")), "least")
        joined = large.join(lower, "a")
        small = joined.where("b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b")).union(lower.select("a", F.col("_m").alias("b"))).distinct()
        edges = stored(small, "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("v"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
        before = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
