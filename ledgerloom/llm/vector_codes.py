"""Codes of vectors by product quantisation: whole-number Lloyd rounds on cover trees.

A vector's components become whole numbers and are cut into equal parts; each part has its codebook. Every task arranges the vectors
of its own partition, block by block, in one cover tree for each part: a node holds points within its radius of its centre, its
children cover it with half the radius, and its points are a run of the tree's order, so differences of cumulative sums give
the sum of any subtree. The trees are written once and used in all rounds. A round starts at the roots. If even the next best
entry is farther from a node's centre than the best one by more than two radii, the triangle inequality gives the whole subtree to
the best, and only its sum and count move. Nodes that are not settled go on to their children, and leaves that are not to an exact
comparison, where ties go to the lower entry. Tasks send one sum for each entry; nothing else leaves them."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored
from ledgerloom.llm.token_files import small_batches

BLOCK = 16_384     # vectors in a set of trees
LEAF = 24          # points that are not split further
LARGEST = 1 << 28  # of a whole-number component


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """Components times ``scale``, rounded down; null for a vector that is null or holds a null or non-finite component.
    Components beyond 2^28 after scaling are held there, so that no sum of squares overflows."""
    x = F.transform(vector, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return F.when(fine, F.transform(x, lambda v: F.floor(F.least(F.greatest(v * scale, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))).cast("int")))


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """An order of ``points`` and the tree's nodes: first and last place, first and last child, squared radius. A node's centre
    is the point at its first place, which is also the centre of its first child; its children are neighbours in the table."""
    order = np.arange(len(points))
    nodes = [[0, len(points), 0, 0, 0]]
    at = 0
    while at < len(nodes):
        lo, hi = nodes[at][:2]
        here = order[lo:hi]
        mine = points[here]
        away = ((mine - mine[0]) ** 2).sum(axis=1)
        radius = nodes[at][4] = int(away.max())
        if hi - lo > leaf and radius:
            groups, rest, first = [], np.arange(hi - lo), len(nodes)
            while len(rest):
                near = 4 * (away[rest] if not groups else ((mine[rest] - mine[rest[0]]) ** 2).sum(axis=1)) <= radius
                groups.append(rest[near])
                rest = rest[~near]
            order[lo:hi] = here[np.concatenate(groups)]
            for g in groups:
                nodes.append([lo, lo + len(g), 0, 0, 0])
                lo += len(g)
            nodes[at][2:4] = [first, len(nodes)]
        at += 1
    return order, np.array(nodes, np.int64)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All whole numbers from each lo to before its hi."""
    n = hi - lo
    return np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return sum((points[:, j, None] - entries[None, :, j]) ** 2 for j in range(points.shape[1]))


def settled(points: np.ndarray, nodes: np.ndarray, entries: np.ndarray, rows: int = 4096) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whole subtrees with their entry, and single points with theirs: every point is in just one of them. ``points`` are in the tree's order."""
    whole, whole_entry, single, single_entry = [], [], [], []
    open_ = np.zeros(min(1, len(points)), np.int64)
    while len(open_):
        following = []
        for i in range(0, len(open_), rows):
            at = open_[i:i + rows]
            lo, hi, first, last, radius = nodes[at].T
            away = squared(points[lo], entries)
            best = away.argmin(axis=1)
            d = np.sqrt(away.astype(float))
            reach = (d[np.arange(len(at)), best] + 2 * np.sqrt(radius.astype(float))) * (1 + 1e-9) + 1e-9
            alone = (d <= reach[:, None]).sum(axis=1) == 1
            whole.append(at[alone])
            whole_entry.append(best[alone])
            leaf = ~alone & (first == last)
            single.append(_ranges(lo[leaf], hi[leaf]))
            following.append(_ranges(first[~alone], last[~alone]))
        open_ = np.concatenate(following)
    ids = np.concatenate(single) if single else np.empty(0, np.int64)
    for i in range(0, len(ids), rows):
        single_entry.append(squared(points[ids[i:i + rows]], entries).argmin(axis=1))
    empty = [np.empty(0, np.int64)]
    return np.concatenate(whole or empty), np.concatenate(whole_entry or empty), ids, np.concatenate(single_entry or empty)


_TREES = "vec_id array<bigint>, label array<string>, trees array<struct<points: binary, order: binary, nodes: binary>>"


def _plant(parts: int):
    def block(ids: list, labels: list, vectors: np.ndarray) -> pa.RecordBatch:
        trees = []
        for p in np.split(vectors, parts, axis=1):
            order, nodes = cover_tree(p.astype(np.int64))
            trees.append({"points": p[order].astype("<i4").tobytes(), "order": order.astype("<i4").tobytes(), "nodes": nodes.astype("<i8").tobytes()})
        kind = pa.list_(pa.struct([("points", pa.binary()), ("order", pa.binary()), ("nodes", pa.binary())]))
        return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.string())), pa.array([trees], kind)], names=["vec_id", "label", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, held = [], [], [], 0
        for b in batches:
            if b.num_rows == 0:
                continue
            ids += b.column(0).to_pylist()
            labels += b.column(1).to_pylist()
            vectors.append(b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1))
            held += b.num_rows
            if held >= BLOCK:
                yield block(ids, labels, np.concatenate(vectors))
                ids, labels, vectors, held = [], [], [], 0
        if held:
            yield block(ids, labels, np.concatenate(vectors))
    return run


def _read(trees: pa.Array) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    out = []
    for t in trees:
        order = np.frombuffer(t["order"].as_py(), "<i4")
        out.append((np.frombuffer(t["points"].as_py(), "<i4").reshape(len(order), -1).astype(np.int64), order, np.frombuffer(t["nodes"].as_py(), "<i8").reshape(-1, 5)))
    return out


def _sums(books: np.ndarray):
    """Counts and sums of the points of each entry, over all trees of a task."""
    parts, k, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, k, width + 1), np.int64)
        for b in batches:
            for row in b.column(0):
                for part, (points, _, nodes) in enumerate(_read(row)):
                    cumulative = np.concatenate([np.zeros((1, width), np.int64), np.cumsum(points, axis=0)])
                    at, entry, ids, own = settled(points, nodes, books[part])
                    np.add.at(total[part, :, 1:], entry, cumulative[nodes[at, 1]] - cumulative[nodes[at, 0]])
                    np.add.at(total[part, :, 0], entry, nodes[at, 1] - nodes[at, 0])
                    np.add.at(total[part, :, 1:], own, points[ids])
                    np.add.at(total[part, :, 0], own, 1)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel()[cells])], names=["cell", "value"])
    return run


def _coded(books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, labels, row in zip(*b.columns, strict=True):
                error, codes = np.zeros(len(ids), np.int64), np.zeros((len(ids), len(books)), np.uint8)
                for part, (points, order, nodes) in enumerate(_read(row)):
                    at, entry, single, own = settled(points, nodes, books[part])
                    code = np.empty(len(points), np.int64)
                    code[_ranges(nodes[at, 0], nodes[at, 1])] = np.repeat(entry, nodes[at, 1] - nodes[at, 0])
                    code[single] = own
                    codes[order, part] = code
                    error[order] += ((points - books[part][code]) ** 2).sum(axis=1)
                text = codes.tobytes().hex()
                step = 2 * len(books)
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, pa.array([text[i:i + step] for i in range(0, len(text), step)], pa.string()), pa.array(error)],
                                                 names=["vec_id", "label", "code", "error"])
    return run


def train(trees: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """Codebooks after ``rounds`` Lloyd rounds. What comes back from a round is one number for each component of the codebooks."""
    for _ in range(rounds):
        total = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
        cells = trees.select("trees").mapInArrow(_sums(books), "cell bigint, value bigint").groupBy("cell").agg(F.sum("value").alias("value"))
        for r in cells.collect():
            total.reshape(-1)[r["cell"]] = r["value"]
        used = total[:, :, 0] > 0
        books = np.where(used[:, :, None], total[:, :, 1:] // np.maximum(total[:, :, :1], 1), books)
    return books


def books_digest(books: np.ndarray) -> str:
    return sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, vector: str = "embedding") -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for every row of ``vectors`` (vec_id, label, ``vector``) with a finite vector.

    A vector that is null or holds a null or non-finite component gives no row. Codebooks start as the parts of the ``entries`` least
    vec_ids - among equal ones the least vectors, null ids last - and have fewer entries where there are fewer vectors. The length of the
    first of these is the table's: a vector of another length, or any if it is not a positive multiple of ``parts``, has a null code and
    error and takes no part. Equal vectors and equal vec_ids are rows of their own. ``label_error`` is null where no vector of the label has an
    error. An empty table gives no rows. Other columns are not read."""
    spark: SparkSession = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"), whole_numbers(F.col(vector)).alias("x")).where("x IS NOT NULL")
    rows = stored(rows, "vector-parts")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()   # a codebook's entries
    length = len(first[0]["x"]) if first else 0
    fits = length > 0 and length % parts == 0
    start = [r["x"] for r in first if len(r["x"]) == length] if fits else []
    same = F.size("x") == length if fits else F.lit(False)
    if start:
        books = np.array(start, np.int64).reshape(len(start), parts, length // parts).transpose(1, 0, 2)
        trees = stored(rows.where(same).mapInArrow(_plant(parts), _TREES), "vector-trees")
        books = train(trees, books, rounds)
        coded, digest = trees.mapInArrow(_coded(books), "vec_id bigint, label string, code string, error bigint"), books_digest(books)
    else:
        none = F.lit(None)
        coded, digest = rows.where("false").select("vec_id", "label", none.cast("string").alias("code"), none.cast("bigint").alias("error")), books_digest(np.empty(0))
    odd = rows.where(~same).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    coded = stored(coded.unionByName(odd), "vector-codes")
    totals = stored(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "vector-labels")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("_label"))).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
