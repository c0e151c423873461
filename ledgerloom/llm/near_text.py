"""Near-duplicate groups of texts by exact Jaccard similarity of their word shingles: every pair of at least 4/5 is linked.

Sets are joined by prefixes. In any order of all shingles, two sets of Jaccard 4/5 or more share at least ceil(4 (x + y) / 9) of
their x and y shingles; if a set shows only its first x - ceil(4 x / 5) + EXTRA, the pair still shares so many of these that no
pair is lost (``needed``). Rare shingles come first, so that few sets meet by chance. The order is estimated from a sample of
the texts and decides about speed alone: any order finds the same pairs.

A shingle that many sets show would make pairs with the square of them. So the sets of such a shingle are first compared with one of
them, and components are taken; after that only sets of different components are paired. Candidates are compared shingle by shingle on their texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import BLANKS, stored
from ledgerloom.llm.components import components
from ledgerloom.llm.token_files import small_batches

EXTRA = 4   # more shingles shown, so that as many more must be shared
_MIX = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def words_of(text: bytes) -> list[bytes]:
    """Only A-Z are lower-cased and only ASCII blanks part words."""
    return text.lower().split()


def shingle_set(words: list[bytes], shingle: int, seen: dict[bytes, int]) -> np.ndarray:
    """64-bit names of the different shingles, sorted; a text of fewer words is one shingle. ``seen`` keeps words' hashes."""
    if not words:
        return np.empty(0, np.uint64)
    if len(seen) > 400_000:
        seen.clear()
    for w in set(words).difference(seen):
        seen[w] = xxhash.xxh64_intdigest(w, 42)
    h = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
    size = min(shingle, len(h))
    out = np.zeros(len(h) - size + 1, np.uint64)
    for i in range(size):
        out = (out ^ h[i:len(h) - size + 1 + i]) * _MIX[i % len(_MIX)]
        out ^= out >> np.uint64(29)
    return np.unique(out)


def shown(n):
    """How many of its n shingles a set shows."""
    return np.minimum(n, n - -(-4 * n // 5) + EXTRA)


def needed(x, y):
    """How many shown shingles two sets of x and y shingles share at least if their Jaccard similarity is 4/5 or more."""
    return -(-4 * (x + y) // 9) - np.maximum(x - shown(x), y - shown(y))


def alike(a: bytes, b: bytes, shingle: int) -> bool:
    sets = []
    for words in (words_of(a), words_of(b)):
        size = min(shingle, len(words))
        sets.append({tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set())
    both = len(sets[0] & sets[1])
    return 5 * both >= 4 * (len(sets[0]) + len(sets[1]) - both)


def _common(classes: DataFrame, shingle: int, sample: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of shingles that are frequent in about ``sample`` texts, at most ``most`` of them, and how often they are there: used for the order alone."""
    share = min(1.0, sample / max(1, classes.count()))

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for b in batches:
            for t in b.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(words_of(t.as_py()), shingle, seen).view(np.int64))], names=["key"])
    drawn = classes.where(F.pmod(F.xxhash64("c"), F.lit(1 << 20)) < int(share * (1 << 20))).select("text")
    rows = (drawn.mapInArrow(names, "key bigint").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            .orderBy(F.desc("n"), "key").limit(most).toArrow())
    key, n = rows.column("key").to_numpy().astype(np.int64).view(np.uint64), rows.column("n").to_numpy()
    at = np.argsort(key)
    return key[at], n[at]


def _shared_keys(classes: DataFrame, shingle: int, sample: int, most: int) -> DataFrame:
    """``key, n, c``: the shown shingles of every set that another set shows too."""
    key, often = _common(classes, shingle, sample, most)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for b in batches:
            keys, n, c = [], [], []
            for t, name in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                own = shingle_set(words_of(t.as_py()), shingle, seen)
                if not len(own):
                    continue
                first = own
                if len(key):
                    at = np.minimum(np.searchsorted(key, own), len(key) - 1)
                    first = own[np.argsort(np.where(key[at] == own, often[at], 0), kind="stable")]
                keys.append(first[:int(shown(len(own)))])
                n.append(np.full(len(keys[-1]), len(own)))
                c.append(np.full(len(keys[-1]), name))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(n)), pa.array(np.concatenate(c))], names=["key", "n", "c"])

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, last = None, None   # the row that waits for its successor, and the key before it
        for b in batches:
            if not b.num_rows:
                continue
            whole = pa.Table.from_batches([b] if before is None else [before, b]).combine_chunks()
            k = whole.column(0).to_numpy()
            same = k[1:] == k[:-1]
            ahead = np.append(False, same)
            ahead[0] = k[0] == last
            keep = (ahead | np.append(same, False))[:-1]
            if keep.any():
                yield from whole.slice(0, len(k) - 1).filter(pa.array(keep)).to_batches()
            last = k[-2] if len(k) > 1 else last
            before = whole.slice(len(k) - 1).combine_chunks().to_batches()[0]
        if before is not None and before.column(0)[0].as_py() == last:
            yield before
    form = "key bigint, n bigint, c bigint"
    rows = classes.select(F.col("text").cast("binary"), "c").mapInArrow(prefixes, form)
    return stored(rows.repartition("key").sortWithinPartitions("key").mapInArrow(repeated, form), "near-keys")


def _verified(pairs: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """The pairs (a, b) whose texts are alike."""
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for x, y in batches:
            yield pa.array([alike(p.as_py(), q.as_py(), shingle) for p, q in zip(x, y, strict=True)], pa.bool_())
    text = lambda end, name: classes.select(F.col("c").alias(end), F.col("text").cast("binary").alias(name))
    known = pairs.join(text("a", "_x"), "a").join(text("b", "_y"), "b")
    return known.withColumn("_alike", F.arrow_udf(run, "boolean").asNondeterministic()("_x", "_y")).where("_alike").select("a", "b")


def close_sets(key: np.ndarray, n: np.ndarray, c: np.ndarray, root: np.ndarray) -> list[np.ndarray]:
    """``a, b, x, y, times``: the pairs of different roots and fitting sizes that share a key, and how many keys they share. Sorted by key."""
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    longest = int(np.diff(np.append(starts, len(key))).max()) if len(key) else 0
    found = np.empty((0, 5), np.int64)
    live = np.arange(len(key))
    for s in range(1, longest):
        live = live[live + s < len(key)]
        live = live[key[live] == key[live + s]]
        i, j = live, live + s
        fits = (root[i] != root[j]) & (5 * np.minimum(n[i], n[j]) >= 4 * np.maximum(n[i], n[j]))
        i, j = i[fits], j[fits]
        turn = c[i] > c[j]
        i, j = np.where(turn, j, i), np.where(turn, i, j)
        found = np.concatenate([found, np.stack([c[i], c[j], n[i], n[j], np.ones(len(i), np.int64)], axis=1)])
        if len(found) > 400_000:
            found = _summed(found)
    return list(_summed(found).T)


def _summed(found: np.ndarray) -> np.ndarray:
    if not len(found):
        return found
    found = found[np.lexsort((found[:, 1], found[:, 0]))]
    new = np.flatnonzero(np.append(True, (found[1:, :2] != found[:-1, :2]).any(axis=1)))
    out = found[new]
    out[:, 4] = np.add.reduceat(found[:, 4], new)
    return out


def links(classes: DataFrame, shingle: int = 5, sample: int = 20_000, most: int = 1 << 17, hot: int = 32, block: int = 1024) -> DataFrame:
    """``a, b``: names of ``classes`` (c, text, different texts) whose links connect the same ones as all pairs of Jaccard 4/5 or more do."""
    small_batches(classes.sparkSession)
    keyed = _shared_keys(classes, shingle, sample, most)
    sizes = stored(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("g"), F.min(F.struct(F.xxhash64("key", "c").alias("h"), "c"))["c"].alias("_one")), "near-sizes")
    stars = (keyed.join(sizes.where(F.col("g") > hot), "key").where("c <> _one")
             .select(F.least("c", "_one").alias("a"), F.greatest("c", "_one").alias("b")).distinct())
    sure = stored(_verified(stars, classes, shingle), "near-stars")
    roots = components(sure)
    rooted = stored(keyed.join(sizes.select("key", "g"), "key").join(roots.withColumnRenamed("v", "c"), "c", "left").withColumn("root", F.coalesce("root", "c")), "near-rooted")
    # a key with many sets is cut into blocks, and each pair of blocks meets on its own
    blocks = F.ceil(F.col("g") / block).cast("int")
    own = F.pmod(F.xxhash64("c"), blocks).cast("int")
    met = F.when(F.col("g") <= block, F.array("key")).otherwise(F.transform(F.sequence(F.lit(0), blocks - 1), lambda x: F.xxhash64("key", F.least(x, own), F.greatest(x, own))))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rest = ["a", "b", "x", "y", "times"], np.empty((4, 0), np.int64)
        for batch in batches:
            rest = np.concatenate([rest, np.stack([x.to_numpy() for x in batch.columns])], axis=1)
            whole = int(np.searchsorted(rest[0], rest[0][-1])) if rest.shape[1] else 0   # the last key may go on in the next batch
            if whole:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in close_sets(*rest[:, :whole])], names=names)
                rest = rest[:, whole:]
        if rest.shape[1]:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in close_sets(*rest)], names=names)
    pairs = (rooted.select(F.explode(met).alias("key"), "n", "c", "root").repartition("key").sortWithinPartitions("key")
             .mapInArrow(compare, "a bigint, b bigint, x bigint, y bigint, times bigint").groupBy("a", "b", "x", "y").agg(F.sum("times").alias("times")))

    def enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y, times = (b.column(i).to_numpy() for i in (2, 3, 4))
            yield b.filter(pa.array(times >= needed(x, y))).select(["a", "b"])
    candidates = stored(pairs.mapInArrow(enough, "a bigint, b bigint"), "near-candidates")
    return sure.unionByName(_verified(candidates, classes, shingle))


def first_of_groups(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """One row of ``docs`` (doc_id, text, ..) for each group of texts that links of Jaccard 4/5 or more reach: the least doc_id's, null last.

    Equal texts are one class, named by 64 bits of a hash, and texts without a word are another. Of rows that agree in doc_id and text one
    stays; two texts of one doc_id are two documents."""
    text = F.coalesce(F.col("text"), F.lit(""))
    named = docs.withColumn("_c", F.when(F.btrim(text, F.lit(BLANKS)) == "", F.lit(0).cast("bigint")).otherwise(F.xxhash64(text)))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    classes = stored(named.groupBy("_c").agg(F.min(text).alias("text"), F.min(rank).alias("least")).withColumnRenamed("_c", "c"), "near-classes")
    roots = components(links(classes.where("c <> 0").select("c", "text"), shingle))
    placed = classes.select("c", "least").join(roots.withColumnRenamed("v", "c"), "c", "left")
    best = placed.groupBy(F.coalesce("root", "c").alias("root")).agg(F.min(F.struct("least", "c")).alias("m")).select(F.col("m.c").alias("_k"), F.col("m.least.id").alias("_id"))
    best = stored(best, "near-kept")
    kept = named.join(best, (F.col("_c") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    again = stored(named.groupBy("_c", "doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("_c").alias("_a"), F.col("doc_id").alias("_b")), "near-again")
    twice = (F.col("_c") == F.col("_a")) & F.col("doc_id").eqNullSafe(F.col("_b"))
    once = kept.join(again, twice, "left_anti").unionByName(kept.join(again, twice, "left_semi").dropDuplicates(["_c", "doc_id"]))
    return once.select(*docs.columns)
