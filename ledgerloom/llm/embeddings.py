"""Near-duplicate vectors by lattice hashing: random projections decoded to points of the E8 lattice, cosine verified."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored
from ledgerloom.llm.components import components, forest
from ledgerloom.llm.token_files import small_batches


@dataclass(frozen=True)
class Lattice:
    tables: int = 4
    cell: float = 1.2       # lattice unit as a multiple of the largest distance of a link
    probes: int = 6         # neighbouring cells looked up beside a vector's own, nearest first
    seed: int = 5


def decode_e8(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point to each row of 8 numbers, times two so that coordinates are whole. E8 is D8 and D8 shifted by one half:
    both are rounded to, the coordinate furthest from its number is turned where the sum is odd, and the nearer wins."""
    def d8(y: np.ndarray) -> np.ndarray:
        near = np.rint(y)
        off = y - near
        odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
        worst = np.abs(off[odd]).argmax(axis=1)
        near[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
        return near
    whole, half = d8(x), d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.rint(2 * np.where(nearer[:, None], whole, half)).astype(np.int64)


def shortest_vectors() -> np.ndarray:
    """The 240 vectors from an E8 point to its nearest neighbours, times two: two coordinates of +-2, or all +-1 with an even number of minus signs."""
    pairs = [(i, j, a, b) for i in range(8) for j in range(i + 1, 8) for a in (-2, 2) for b in (-2, 2)]
    two = np.zeros((len(pairs), 8), np.int64)
    for k, (i, j, a, b) in enumerate(pairs):
        two[k, i], two[k, j] = a, b
    signs = 1 - 2 * ((np.arange(256)[:, None] >> np.arange(8)) & 1)
    return np.concatenate([two, signs[(signs < 0).sum(axis=1) % 2 == 0]])


def _hash(points: np.ndarray, table: int) -> np.ndarray:
    """A 64-bit key of lattice points (last axis 8)."""
    h = np.full(points.shape[:-1], 0x9E3779B97F4A7C15 ^ (table + 1), np.uint64)
    for k in range(8):
        h = (h ^ points[..., k].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def cells(unit: np.ndarray, lattice: Lattice, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Own cell and the probed cells of unit vectors in each table: (n, tables) and (n, tables, probes)."""
    n, d = unit.shape
    unit_length = lattice.cell * np.sqrt(2 - 2 * least)
    rng = np.random.default_rng(lattice.seed)
    near = shortest_vectors()
    own, probed = np.empty((n, lattice.tables), np.int64), np.empty((n, lattice.tables, lattice.probes), np.int64)
    for t in range(lattice.tables):
        axes = np.linalg.qr(rng.normal(size=(d, 8)))[0] if d >= 8 else np.eye(8)[:d]
        x = unit @ axes * np.sqrt(max(d, 8) / 8) / unit_length + rng.uniform(0, 1, 8)   # 8 of d axes keep 8 / d of a squared distance
        point = decode_e8(x)
        own[:, t] = _hash(point, t)
        if lattice.probes:
            gain = (2 * x - point) @ near.T   # all neighbours are equally far from the point: the nearest to x lies in its direction
            best = np.argpartition(-gain, lattice.probes - 1, axis=1)[:, :lattice.probes]
            probed[:, t] = _hash(point[:, None, :] + near[best], t)
    return own, probed


def unit_rows(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as unit vectors in double precision."""
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    start = column.offsets[0].as_py()
    x = values[start:column.offsets[-1].as_py()].reshape(len(column), -1) if len(column) else np.empty((0, 1))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of one key at a time from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for x, y in zip(cuts[:-1], cuts[1:]):
            if y > x:
                if held and held[-1].column(key)[0].as_py() != keys[x]:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(x, y - x))
    if held:
        yield pa.Table.from_batches(held)


def blocked(rows: DataFrame, by: list[str], vertex: str, block: int) -> DataFrame:
    """``rows`` with a ``_meet`` key: rows of one ``by`` meet in one place, or, where they are more than ``block``, in one place for each
    pair of their blocks, a row in as many as there are blocks. ``_own`` is a row's block, ``_pair`` the pair's."""
    sizes = stored(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*by, F.ceil(F.col("_n") / block).cast("int").alias("_blocks")), "block-sizes")
    own = F.pmod(F.xxhash64(vertex, F.lit("block")), F.col("_blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda x: F.struct(F.least(x, F.col("_own")).alias("x"), F.greatest(x, F.col("_own")).alias("y")))
    return (rows.join(sizes, by).withColumn("_own", own).withColumn("_pair", F.explode(pairs))
            .withColumn("_meet", F.xxhash64(*by, "_pair.x", "_pair.y")))


def candidate_links(vectors: DataFrame, least: float, lattice: Lattice, block: int = 512) -> DataFrame:
    """``a, b``: links among ``vectors`` (v, embedding), enough of them to connect what the found pairs connect.

    A vector stands in its own cell of each table and visits the nearest neighbouring cells. Those who stand in a cell
    are compared with all who stand in it or visit it, inside the task; a cell with more than ``block`` rows is
    compared block by block. Of each cell a forest of the links goes on, fewer than its rows."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                own, probed = cells(unit_rows(part.column(1)), lattice, least)
                keys = np.concatenate([own[:, :, None], probed], axis=2).reshape(part.num_rows, -1)
                each = keys.shape[1]
                home = np.zeros((lattice.tables, 1 + lattice.probes), bool)
                home[:, 0] = True
                who = np.repeat(np.arange(part.num_rows), each)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.tile(home.ravel(), part.num_rows)), part.column(0).take(pa.array(who)),
                                                  part.column(1).take(pa.array(who))], names=["cell", "home", "v", "embedding"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, "_meet"):
            x = unit_rows(run["embedding"].combine_chunks())
            v, home, first = (run[c].to_numpy() for c in ("v", "home", "_first"))
            # of two blocks, one's residents meet the other's rows; a block alone meets itself
            near = x[home] @ x.T >= least
            near &= (first[home][:, None] != first[None, :]) | bool(run["_alone"][0].as_py())
            i, j = np.nonzero(near)
            a, b = forest(v[home][i], v[j])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
    rows = vectors.select("v", "embedding").mapInArrow(hashed, "cell bigint, home boolean, v bigint, embedding array<float>")
    met = (blocked(rows, ["cell"], "v", block)
           .select("_meet", "v", "home", "embedding", (F.col("_own") == F.col("_pair.x")).alias("_first"), (F.col("_pair.x") == F.col("_pair.y")).alias("_alone")))
    return met.repartition("_meet").sortWithinPartitions("_meet").mapInArrow(compared, "a bigint, b bigint")


def link_counts(placed: DataFrame, least: float, block: int = 512) -> DataFrame:
    """``v, n``: for ``placed`` (v, embedding, size, root), the summed sizes of the other vectors of its component within ``least``.

    Links never leave a component, so all of them are counted, block against block, and nothing but a number a row
    leaves a task. The work is the square of a component, which is what its links may be."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, "_meet"):
            x = unit_rows(run["embedding"].combine_chunks())
            v, size, first = (run[c].to_numpy() for c in ("v", "size", "_first"))
            near = (x @ x.T >= least) & (v[:, None] != v[None, :])
            near &= (first[:, None] != first[None, :]) | bool(run["_alone"][0].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(near @ size)], names=["v", "n"])
    met = (blocked(placed, ["root"], "v", block)
           .select("_meet", "v", "size", "embedding", (F.col("_own") == F.col("_pair.x")).alias("_first"), (F.col("_pair.x") == F.col("_pair.y")).alias("_alone")))
    return met.repartition("_meet").sortWithinPartitions("_meet").mapInArrow(counted, "v bigint, n bigint").groupBy("v").agg(F.sum("n").alias("n"))


def linked_vectors(table: DataFrame, least: float = 0.95, lattice: Lattice = Lattice()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``table`` (vec_id, embedding).

    Rows of one vector are a class from the start, found by a combining aggregate; they link with each other. A vector
    that is null, empty, zero or holds a null or a non-finite number links with nothing. Vectors of different lengths never
    link. A null vec_id takes part in links; it is kept if its component has no other id. kept is vec_id = component_id."""
    small_batches(table.sparkSession)
    e = F.col("embedding")
    good = F.coalesce(e.isNotNull() & (F.size(e) > 0) & F.exists(e, lambda x: x != 0) & ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
    rows = table.select("vec_id", F.when(good, F.transform(e, lambda x: x.cast("float"))).alias("embedding"))
    classes = stored(rows.where("embedding IS NOT NULL").groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("size"))
                     .withColumn("v", F.xxhash64("embedding")), "vectors")
    lengths = [r[0] for r in classes.select(F.size("embedding")).distinct().collect()]   # one row for each length
    links = None
    for d in lengths:
        found = candidate_links(classes.where(F.size("embedding") == d), least, lattice)
        links = found if links is None else links.unionByName(found)
    if links is None:
        links = table.sparkSession.createDataFrame([], "a bigint, b bigint")
    roots = components(links).withColumnRenamed("root", "_root")
    placed = stored(classes.join(roots, "v", "left").select("v", "embedding", "size", "least", F.coalesce("_root", "v").alias("root")), "vector-roots")
    counts = link_counts(placed, least)
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    each = (placed.join(ids, "root").join(counts, "v", "left")
            .select("embedding", "component_id", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links")))
    done = rows.join(each, "embedding", "left")
    component = F.when(F.col("embedding").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return done.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                       F.col("vec_id").eqNullSafe(component).alias("kept"))
