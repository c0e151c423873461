"""SimHash fingerprints and near-duplicate groups by the general pigeonhole principle.

Fingerprints within ``radius`` bits are found as follows. Their 64 bits are grouped, correlated bits together, into m parts, and
part i gets a threshold t_i >= -1 with t_1 + ... + t_m = radius - m + 1. Whatever the thresholds, two fingerprints within
``radius`` are within t_i in some part i (else they would differ in at least sum(t_i + 1) = radius + 1 bits). Dynamic
programming picks the thresholds, unequal as the parts are, that give the fewest candidates by estimate, over all m.
A fingerprint is looked up in part i under its value with every choice of t_i bits blanked, so equal keys are just
the pairs within t_i; a threshold of -1 needs no look-up. Candidates are verified on all 64 bits."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored
from ledgerloom.llm.components import components, forest
from ledgerloom.llm.token_files import small_batches
from ledgerloom.operators.ordered import first_per_key

BITS = 64


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of a text's word shingles, repeats counted: XXH64 with seed 42 of each, then the majority of every bit."""
    words = text.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    last = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    first = [0, *ends.tolist()][:len(last)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(flat[x:y], 42) for x, y in zip(first, last, strict=True)], "<u8")
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(text: Column, shingle: int = 3) -> Column:
    """The fingerprint of a text column as a signed long. Only A-Z are lower-cased and only ASCII blanks part words; a null or blank
    text gives zero, a text of fewer words than a shingle is one shingle."""
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([fingerprint(t.as_py(), shingle) for t in batch], pa.int64())
    return F.arrow_udf(run, "bigint")(F.coalesce(text, F.lit("")).cast("binary"))


def _together(classes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have bits i and j set, for all i, j: 64 x 64 sums whatever the input."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            bits = np.unpackbits(b.column(0).to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total, n = total + bits.T @ bits, n + len(bits)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS + 1)), pa.array(np.append(total.ravel(), n).astype(np.int64))], names=["cell", "n"])
    rows = classes.select("fp").mapInArrow(sums, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1)
    for r in rows:
        flat[r["cell"]] = r["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def group_bits(n: int, together: np.ndarray, m: int) -> list[list[int]]:
    """m parts of nearly equal size. Each starts with the strongest correlated pair left and takes the bit of highest total
    correlation with it until it is full."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    strength = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(strength, -1)
    left, parts = list(range(BITS)), []
    for i in range(m):
        size = BITS // m + (i < BITS % m)
        block = strength[np.ix_(left, left)]
        a, b = divmod(int(block.argmax()), len(left))
        part = [left[a], left[b]] if a != b else left[:2]
        while len(part) < size:
            rest = [x for x in left if x not in part]
            part.append(rest[int(strength[np.ix_(rest, part)].sum(axis=1).argmax())])
        parts.append(sorted(part))
        left = [x for x in left if x not in part]
    return parts


def _same_values(classes: DataFrame, parts: list[list[int]]) -> list[float]:
    """For each part, the pairs of fingerprints with the same value in it, counted over all fingerprints."""
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(_mask(x)).alias("value")) for i, x in enumerate(parts)])).alias("x")
    n = classes.select(values).groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    rows = n.groupBy("x.part").agg(F.sum(F.col("n").cast("double") * (F.col("n") - 1) / 2).alias("pairs")).collect()   # a row for each part
    found = {r["part"]: r["pairs"] for r in rows}
    return [found.get(i, 0.0) for i in range(len(parts))]


def _mask(bits) -> int:
    x = sum(1 << b for b in bits)
    return x - (1 << 64) if x >> 63 else x


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds, one for each part, that sum to ``total`` at the least cost. ``costs[i][t + 1]`` is part i's cost at threshold
    t, -1 first. Dynamic programming over parts and the sum so far."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, c in enumerate(part, -1):
                if used + t not in following or cost + c < following[used + t][0]:
                    following[used + t] = (cost + c, [*chosen, t])
        best = following
    return best[total]


def plan(classes: DataFrame, radius: int, most_parts: int = 8) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the parts to look up in: the cheapest allocation over all numbers of parts.

    Cost is estimated candidates plus look-ups. Candidates at threshold 0 are counted exactly; at t they grow by the ratio of
    the chances that as many independent bits, each as balanced as measured, differ in t at most."""
    n, together = _together(classes)
    differ = 2 * np.diag(together) / max(n, 1) * (1 - np.diag(together) / max(n, 1))
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for m in range(2, min(most_parts, radius + 1) + 1):
        parts = group_bits(n, together, m)
        costs = []
        for bits, same in zip(parts, _same_values(classes, parts), strict=True):
            chance = np.array([1.0] + [0.0] * radius)   # of 0, 1, .. bits that differ
            for q in differ[bits]:
                chance = chance * (1 - q) + np.concatenate([[0.0], chance[:-1]]) * q
            within = np.cumsum(chance) / max(chance[0], 1e-300)
            costs.append([0.0] + [(same + 1) * within[t] + 4.0 * n * comb(len(bits), t) for t in range(radius + 1)])
        cost, thresholds = allocate(costs, radius - m + 1)
        if best is None or cost < best[0]:
            best = (cost, [(b, t) for b, t in zip(parts, thresholds, strict=True) if t >= 0])
    return best[1]


def _keys(looked: list[tuple[list[int], int]]) -> Column:
    """All keys a fingerprint is looked up under: of each part, its value with every choice of threshold bits blanked."""
    keys = []
    for i, (bits, t) in enumerate(looked):
        for blank in combinations(bits, t):
            keys.append(F.xxhash64(F.lit(i), F.lit(_mask(blank)), F.col("fp").bitwiseAND(_mask(set(bits) - set(blank)))))
    return F.array(*keys)


def close_pairs(fp: np.ndarray, key: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links within ``radius`` among fingerprints of equal keys; ``key`` is sorted. Every pair of a key is
    compared, shift by shift, in pieces; a piece's links are contracted before the next."""
    x = fp.view(np.uint64)
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    longest = int(np.diff(np.append(starts, len(key))).max()) if len(key) else 0
    a = b = np.empty(0, np.int64)
    live = np.arange(len(key))
    for s in range(1, longest):
        live = live[live + s < len(key)]
        live = live[key[live] == key[live + s]]
        near = live[np.bitwise_count(x[live] ^ x[live + s]) <= radius]
        near = near[fp[near] != fp[near + s]]
        if len(near):
            a, b = np.append(a, fp[near]), np.append(b, fp[near + s])
        if len(a) > 200_000:
            a, b = forest(a, b)
    return forest(a, b)


def links(classes: DataFrame, radius: int = 3, block: int = 1024) -> DataFrame:
    """``a, b``: fingerprints of ``classes`` (fp, distinct) whose links connect the same ones as all pairs within ``radius`` do.

    All fingerprints of a key meet in one task, sorted, and are compared there; no pair is a row. A key with more than
    ``block`` fingerprints is cut into blocks by a hash, and each pair of blocks meets on its own, so one key never
    fills a task: the work on it grows with its square, the rows only with its square over ``block``."""
    looked = plan(classes, radius)
    keyed = stored(classes.select("fp", F.explode(_keys(looked)).alias("key")), "simhash-keys")
    sizes = stored(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-sizes")
    large = sizes.where(F.col("n") > block).select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    small = keyed.join(sizes.where(F.col("n") <= block).select("key"), "key", "left_semi")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.xxhash64("key", F.least(x, F.col("own")), F.greatest(x, F.col("own"))))
    cut = keyed.join(large, "key").withColumn("own", own).select("fp", F.explode(pairs).alias("key"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = fp = np.empty(0, np.int64)

        def found(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            a, b = close_pairs(f, k, radius)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        for batch in batches:
            key, fp = np.concatenate([key, batch.column(0).to_numpy()]), np.concatenate([fp, batch.column(1).to_numpy()])
            whole = int(np.searchsorted(key, key[-1])) if len(key) else 0   # the last key may go on in the next batch
            if whole:
                yield found(key[:whole], fp[:whole])
                key, fp = key[whole:], fp[whole:]
        if len(key):
            yield found(key, fp)
    met = small.select("key", "fp").unionByName(cut.select("key", "fp"))
    return met.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(compare, "a bigint, b bigint")


def _grouped(docs: DataFrame, radius: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, key, fp`` of every row, ``key`` a hash of its text, and ``fp, root, component_id`` of every fingerprint."""
    small_batches(docs.sparkSession)
    marked = stored(docs.select("doc_id", F.xxhash64("text").alias("key"), fingerprints(F.col("text"), shingle).alias("fp")), "simhash")
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    roots = components(links(classes, radius))
    placed = classes.join(roots.withColumnRenamed("v", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked, placed.join(ids, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs`` (doc_id, text): the least doc_id that links of fingerprints reach.

    Rows with equal fingerprints are one class from the start, found by a combining aggregate, so large groups of copies
    cost nothing more. A null doc_id takes part but is no one's component_id unless its component has no other."""
    marked, groups = _grouped(docs, radius, shingle)
    return marked.join(groups, "fp").select("doc_id", "fp", "component_id")


def first_of_groups(docs: DataFrame, radius: int = 3, shingle: int = 3) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, all columns kept: the one of least doc_id, null last, and of least text hash
    where several share it. Of rows that agree in doc_id and text any one stays. An empty table gives no rows. A column
    named ``_key`` is replaced."""
    marked, groups = _grouped(docs, radius, shingle)
    rows = marked.join(groups.select("fp", "root"), "fp").groupBy("root", "doc_id", "key").agg(F.count(F.lit(1)).alias("n"))
    firsts = stored(rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "n")).alias("x")).select("x.*"), "simhash-firsts")
    mine = docs.withColumn("_key", F.xxhash64("text"))

    def those(which: DataFrame) -> DataFrame:
        named = which.select(F.col("doc_id").alias("_id"), F.col("key").alias("_k"))
        return mine.join(named, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")), "left_semi")
    several = first_per_key(those(firsts.where("n > 1")), ["doc_id", "_key"], [])   # rows that repeat are few, and no others are moved
    return those(firsts.where("n = 1")).unionByName(several).drop("_key")
