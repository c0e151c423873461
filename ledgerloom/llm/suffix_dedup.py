"""Repeated passages by sparse suffix arrays.

Only suffixes at minimisers are kept: the k-word grams that are least by hash among the min_words - k + 1 grams of some window of
min_words words. Equal windows choose equal grams, so a passage of min_words words that repeats has an anchor at the
same place in all its copies. An anchor's context is what the windows that choose it span; all other windows have their own
anchors. Anchors whose gram occurs once are dropped.

Suffixes with equal contexts, told by a hash, are one class, and a class of several suffixes is a repeat. Only where a gram has
several classes are words needed: the first suffix of each class gets its context from its text. Classes are sorted by gram and
following words, neighbours are compared, and their match is extended to the right and to the left; min_words words or more
are a repeat. Between two classes of a gram that is all there is to know. Where a gram has three or more, the longest match to the right need not be the longest in all, nor
a neighbour the earliest copy. There an exact check follows: each class against the gram's first one, then the windows
that differ from it among themselves."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored, words_of
from ledgerloom.llm.token_files import small_batches

_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Passage:
    """What counts as a repeat, and how long a gram is that suffixes are kept at."""

    min_words: int = 50
    gram: int = 20

    @property
    def left(self) -> int:
        return self.min_words - self.gram


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of pairs of hashes."""
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0xD1B54A32D192ED03) + (a << np.uint64(7)))
    x ^= x >> np.uint64(31)
    return x * np.uint64(0xBF58476D1CE4E5B9)


def _shifted(x: np.ndarray, by: int, fill) -> np.ndarray:
    return np.concatenate([x[by:], np.full(min(by, len(x)), fill, x.dtype)])


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k words from each place on, by doubling; places near the end hold nothing of use."""
    g, have = words, 1
    while 2 * have <= k:
        g, have = _join(g, _shifted(g, have, 0)), 2 * have
    return _join(g, _shifted(g, k - have, 0)) if have < k else g


def _sliding(x: np.ndarray, width: int, pick, fill) -> np.ndarray:
    """``pick`` over x[i : i + width] for every i."""
    have = 1
    while 2 * have <= width:
        x, have = pick(x, _shifted(x, have, fill)), 2 * have
    return pick(x, _shifted(x, width - have, fill)) if have < width else x


def anchors(words: np.ndarray, lengths: np.ndarray, passage: Passage) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``words`` - texts of ``lengths`` one after another - that are minimisers, their gram hashes, and how many words
    the windows that choose a place reach back and ahead from it. Of equal least grams in a window all are kept."""
    ends = np.cumsum(lengths)
    left = np.repeat(ends, lengths) - np.arange(len(words))   # words from here to the end of the text
    g = grams(words, passage.gram)
    g = np.where(left >= passage.gram, np.maximum(g, np.uint64(1)), _TOP)
    wide = passage.left + 1
    least = np.where(left >= passage.min_words, _sliding(g, wide, np.minimum, _TOP), np.uint64(0))
    back = _sliding(least[::-1], wide, np.maximum, np.uint64(0))[::-1]   # over the windows that hold this place
    at = np.flatnonzero((back == g) & (g != _TOP))
    padded = np.concatenate([np.zeros(passage.left, np.uint64), least])
    chosen = [padded[at + i] == g[at] for i in range(wide)]   # windows that begin left - i words before; those that choose a place are in a row
    first, last = np.full(len(at), passage.left), np.zeros(len(at), np.int64)
    for i in range(wide):
        first, last = np.where(chosen[i], np.minimum(first, i), first), np.where(chosen[i], i, last)
    return at, g[at], passage.left - first, passage.min_words - passage.left + last


def _classes(words: np.ndarray, at: np.ndarray, back: np.ndarray, ahead: np.ndarray, passage: Passage) -> np.ndarray:
    """A hash of the context of each place, without its gram."""
    flat = np.append(words, np.zeros(passage.min_words, np.uint64))
    out = _join(back.astype(np.uint64), ahead.astype(np.uint64))
    for j in range(passage.left):
        out = _join(out, np.where(passage.gram + j < ahead, flat[at + passage.gram + j], np.uint64(0)))
        out = _join(out, np.where(j < back, flat[at - 1 - j], np.uint64(0)))
    return out


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    ends = np.asarray(column.offsets)
    return column.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]], np.diff(ends)


def _chars(rows: np.ndarray) -> pa.Array:
    """Rows of 32-bit numbers as binary values."""
    n, width = rows.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * width * 4).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _numbers(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, width)


def _same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of two rows of words; zero is no word."""
    differ = (a != b) | (a == 0)
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def _word_hashes(text: Column) -> Column:
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


_ANCHOR = "doc_id bigint, key bigint, pos int, gram bigint, class bigint, back int, ahead int"


def _anchor_rows(passage: Passage):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, lengths = _lists(b.column(2))
            words = words.astype(np.int64).view(np.uint64)
            at, g, back, ahead = anchors(words, lengths, passage)
            ends = np.cumsum(lengths)
            doc = np.searchsorted(ends, at, side="right")
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array((at - (ends - lengths)[doc]).astype(np.int32)), pa.array(g.view(np.int64)),
                                              pa.array(_classes(words, at, back, ahead, passage).view(np.int64)), pa.array(back.astype(np.int32)), pa.array(ahead.astype(np.int32))],
                                             names=["doc_id", "key", "pos", "gram", "class", "back", "ahead"])
    return run


_CONTEXT = "doc_id bigint, key bigint, pos int, gram bigint, class bigint, lead boolean, many boolean, after binary, before binary"


def _context_rows(passage: Passage):
    """Words of a context after its gram, and before it from the gram on; zero where the context ends."""
    steps = np.arange(passage.left)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 200):
                b = whole.slice(i, 200)
                words, lengths = _lists(b.column(2))
                words = np.maximum(words.astype(np.int64).view(np.uint64) >> np.uint64(32), np.uint64(1)).astype(np.uint32)
                flat = np.append(words, np.uint32(0))
                spots = b.column(3).flatten()
                pos, back, ahead = (spots.field(c).to_numpy(zero_copy_only=False) for c in ("pos", "back", "ahead"))
                doc = np.repeat(np.arange(b.num_rows), b.column(3).value_lengths().to_numpy(zero_copy_only=False))
                at = ((np.cumsum(lengths) - lengths)[doc] + pos)[:, None]
                after = flat[np.where(steps < (ahead - passage.gram)[:, None], at + passage.gram + steps, len(words))]
                before = flat[np.where(steps < back[:, None], at - 1 - steps, len(words))]
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), *[spots.field(c) for c in ("pos", "gram", "class", "lead", "many")],
                                                  _chars(after), _chars(before)], names=[c.split()[0] for c in _CONTEXT.split(", ")])
    return run


#: A row's match with a neighbour. ``gone``: the other one is earlier and nothing but these two is in the gram; ``doc_id`` is the other's.
_MATCH = "gram bigint, class bigint, back int, ahead int, gone boolean, doc_id bigint, after binary, before binary"


def _neighbours(passage: Passage):
    """Compares each row with the one before. A partition's first and last row also go on as they are, since their other neighbours
    are in other partitions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            if b.num_rows == 0:
                continue
            if last is None:
                yield _with_edge(b.slice(0, 1))
            rows = b if last is None else pa.Table.from_batches([last, b]).combine_chunks().to_batches()[0]
            last = b.slice(b.num_rows - 1, 1)
            yield from _compared(rows, passage)
        if last is not None:
            yield _with_edge(last)
    return run


def _with_edge(row: pa.RecordBatch) -> pa.RecordBatch:
    """A row of classes in the layout of matches: no match, contexts attached."""
    none = pa.nulls(row.num_rows, pa.int32())
    return pa.RecordBatch.from_arrays([row["gram"], row["class"], none, none, row["gone"], row["doc_id"], row["after"], row["before"]],
                                      names=[c.split()[0] for c in _MATCH.split(", ")])


def _compared(rows: pa.RecordBatch, passage: Passage) -> Iterator[pa.RecordBatch]:
    """Matches of neighbouring rows: for each of the two, how far it reaches and which document the other one is from."""
    if rows.num_rows < 2:
        return
    gram, cls = rows["gram"].to_numpy(), rows["class"].to_numpy()
    after, before = _numbers(rows["after"], passage.left), _numbers(rows["before"], passage.left)
    pair = np.flatnonzero((gram[1:] == gram[:-1]) & (cls[1:] != cls[:-1]))
    ahead, back = passage.gram + _same(after[pair], after[pair + 1]), _same(before[pair], before[pair + 1])
    good = ahead + back >= passage.min_words
    pair, ahead, back = pair[good], ahead[good], back[good]
    if not len(pair):
        return
    me, other = (pa.array(np.concatenate(x)) for x in ((pair, pair + 1), (pair + 1, pair)))
    both = lambda x: pa.array(np.concatenate([x, x]).astype(np.int32))
    empty = pa.nulls(len(me), pa.binary())
    yield pa.RecordBatch.from_arrays([*[rows[c].take(me) for c in ("gram", "class")], both(back), both(ahead), rows["gone"].take(me), rows["doc_id"].take(other), empty, empty],
                                     names=[c.split()[0] for c in _MATCH.split(", ")])


_WINDOW = "gram bigint, class bigint, doc_id bigint, back int, ahead int, gone boolean, spot struct<doc_id:bigint,key:bigint,pos:int>, windows array<struct<back:int,window:bigint>>"


def _window_rows(passage: Passage):
    """A class against the first class of its gram. What they share is settled: it is gone from the class and repeats in the first one
    (``windows`` is null). Of the rest, every window as a hash of its words (``windows``, with the place of the class); a window
    that differs from the first class's differs in all classes that hold it, so equal ones are all among these rows."""
    names = [c.split()[0] for c in _WINDOW.split(", ")]
    place = pa.struct([("doc_id", pa.int64()), ("key", pa.int64()), ("pos", pa.int32())])
    kind = pa.list_(pa.struct([("back", pa.int32()), ("window", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 2000):
                b = whole.slice(i, 2000)
                after, before = _numbers(b["after"], passage.left), _numbers(b["before"], passage.left)
                ahead, behind = passage.gram + _same(after, _numbers(b["lead_after"], passage.left)), _same(before, _numbers(b["lead_before"], passage.left))
                first = b["class"].to_numpy() == b["lead_class"].to_numpy()
                shared = np.flatnonzero((ahead + behind >= passage.min_words) & ~first)
                take, n = pa.array(shared), len(shared)
                for cls, gone in (("class", True), ("lead_class", False)):
                    yield pa.RecordBatch.from_arrays([*[b[c].take(take) for c in ("gram", cls, "lead_doc_id")], pa.array(behind[shared].astype(np.int32)),
                                                      pa.array(ahead[shared].astype(np.int32)), pa.array(np.full(n, gone)), pa.nulls(n, place), pa.nulls(n, kind)], names=names)
                right, left = (np.stack(_prefixes(x), axis=1) for x in (after, before))
                has_right, has_left = passage.gram + (after != 0).sum(axis=1)[:, None], (before != 0).sum(axis=1)[:, None]
                o = np.arange(passage.left + 1)
                fits = (o <= has_left) & (passage.min_words - o <= has_right) & ~first[:, None]
                fits &= (o > behind[:, None]) | (passage.min_words - o > ahead[:, None])
                hashes = _join(_join(left[:, o], right[:, passage.left - o]), np.broadcast_to(o.astype(np.uint64), fits.shape))
                row, back = np.nonzero(fits)
                some = np.flatnonzero(fits.any(axis=1))
                ends = np.append(0, np.cumsum(fits.sum(axis=1)[some])).astype(np.int32)
                pairs = pa.StructArray.from_arrays([pa.array(back.astype(np.int32)), pa.array(hashes[row, back].view(np.int64))], ["back", "window"])
                take, n = pa.array(some), len(some)
                spot = pa.StructArray.from_arrays([b[c].take(take) for c in ("doc_id", "key", "pos")], ["doc_id", "key", "pos"])
                yield pa.RecordBatch.from_arrays([b["gram"].take(take), b["class"].take(take), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()),
                                                  pa.nulls(n, pa.bool_()), spot, pa.ListArray.from_arrays(pa.array(ends), pairs)], names=names)
    return run


def _prefixes(words: np.ndarray) -> list[np.ndarray]:
    """Hashes of the first 0, 1, 2, .. words of each row."""
    out = [np.full(len(words), 0x1234567, np.uint64)]
    for j in range(words.shape[1]):
        out.append(_join(out[-1], words[:, j].astype(np.uint64)))
    return out


def repeated_passages(docs: DataFrame, passage: Passage = Passage()) -> DataFrame:
    """``doc_id, key, start, n_words, first_doc_id, removed``: every maximal stretch of words of ``docs`` (doc_id, text) that lies in
    repeats of ``min_words`` words or more. ``start`` counts words from 0.

    ``removed`` lists (start, n_words) of the stretches in it of which an earlier copy exists, by doc_id (null first), then text, then
    place; it is empty in the first copy. ``first_doc_id`` is the least doc_id among the earlier copies that were met, or the document
    itself. ``key`` tells texts of one doc_id apart; rows that agree in both are one document. Null, empty and shorter texts have no passages. Grams are compared by 64-bit hashes, the words around them by 32 bits each.

    Grams and classes that very many documents share are combined before they are shuffled; joins on them are split by adaptive
    execution; the sort is by range over classes that are all different."""
    small_batches(docs.sparkSession)
    texts = docs.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("key"), "text")
    found = stored(texts.select("doc_id", "key", _word_hashes(F.col("text"))).mapInArrow(_anchor_rows(passage), _ANCHOR), "suffix-anchors")
    # what is joined to hot grams and classes is written first: the join then shuffles both sides anew and can split them
    twice = stored(found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "suffix-grams")
    suffixes = stored(found.join(twice, "gram", "left_semi").select(*found.columns), "suffix-repeated")
    spot = F.struct("doc_id", "key", "pos")
    classes = stored(suffixes.groupBy("gram", "class").agg(F.min(spot).alias("first"), F.max(spot).alias("last"), F.first("back").alias("back"), F.first("ahead").alias("ahead"))
                     .select("gram", "class", "first.*", (F.col("first") != F.col("last")).alias("again"), "back", "ahead"), "suffix-classes")
    several = stored(classes.groupBy("gram").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("doc_id", "key", "pos", "class")).alias("_lead")).where("_n > 1")
                     .select("gram", (F.col("_n") > 2).alias("many"), F.col("_lead.class").alias("_lead")), "suffix-several")
    wanted = (classes.join(several, "gram").groupBy("doc_id", "key")   # as many as a text has anchors
              .agg(F.collect_list(F.struct("pos", "gram", "class", "back", "ahead", (F.col("class") == F.col("_lead")).alias("lead"), "many")).alias("at"))
              .select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "at"))
    some = (texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))
            .select("doc_id", "key", _word_hashes(F.col("text")).alias("words"), "at"))
    contexts = stored(some.mapInArrow(_context_rows(passage), _CONTEXT), "suffix-contexts")
    ordered = contexts.select("gram", "class", "doc_id", (~F.col("lead") & ~F.col("many")).alias("gone"), "after", "before")
    side = stored(ordered.repartitionByRange("gram", "after", "before").sortWithinPartitions("gram", "after", "before").mapInArrow(_neighbours(passage), _MATCH), "suffix-matches")
    edges = (side.where("after IS NOT NULL").select(*ordered.columns).repartition(1)   # two rows for each partition of the sort
             .sortWithinPartitions("gram", "after", "before").mapInArrow(_neighbours(passage), _MATCH))
    lead = contexts.where("many AND lead").select("gram", *[F.col(c).alias("lead_" + c) for c in ("class", "doc_id", "after", "before")])
    pieces = stored(contexts.where("many").drop("lead", "many").join(lead, "gram").mapInArrow(_window_rows(passage), _WINDOW), "suffix-windows")
    windows = pieces.where("windows IS NOT NULL").select("gram", "class", "spot", F.explode("windows").alias("_w")).select("gram", "class", "spot", "_w.*")
    equal = stored(windows.groupBy("gram", "window").agg(F.min(F.struct("spot", "class")).alias("_first"), F.max("class").alias("_max"), F.min("class").alias("_min")).where("_min <> _max")
                   .select("gram", "window", F.col("_first.class").alias("_lead"), F.col("_first.spot.doc_id").alias("doc_id")), "suffix-windows")
    exact = (windows.select("gram", "class", "back", "window").join(equal, ["gram", "window"])
             .select("gram", "class", "back", (F.lit(passage.min_words) - F.col("back")).alias("ahead"), (F.col("class") != F.col("_lead")).alias("gone"), "doc_id"))
    matches = [side.unionByName(edges).where("after IS NULL"), exact, pieces.where("windows IS NULL")]
    none = F.lit(None)
    own = classes.where("again").select("gram", "class", "back", "ahead", none.cast("int").alias("gone_back"), none.cast("int").alias("gone_ahead"), none.cast("bigint").alias("first_id"), spot.alias("own"))
    # the windows of one anchor all hold its gram, so any of them together are one stretch
    reach = [m.groupBy("gram", "class").agg(F.max("back").alias("back"), F.max("ahead").alias("ahead"), F.max(F.when(F.col("gone"), F.col("back"))).alias("gone_back"),
                                            F.max(F.when(F.col("gone"), F.col("ahead"))).alias("gone_ahead"), F.min(F.when(F.col("gone"), F.col("doc_id"))).alias("first_id"))
             .withColumn("own", none.cast("struct<doc_id:bigint,key:bigint,pos:int>")) for m in matches]
    reach = stored(reduce(DataFrame.unionByName, reach, own).groupBy("gram", "class").agg(
        *[F.max(c).alias(c) for c in ("back", "ahead", "gone_back", "gone_ahead", "own")], F.min("first_id").alias("first_id")), "suffix-reach")
    again = F.coalesce(spot > F.col("own"), F.lit(False))   # a later suffix of a class: the first one has all of it
    first_id = F.least("doc_id", "first_id", F.when(again, F.col("own.doc_id")))
    stretch = lambda back, ahead, gone: F.when(F.col(back).isNotNull(), F.struct((F.col("pos") - F.col(back)).alias("start"), (F.col("pos") + F.col(ahead)).alias("end"), F.lit(gone).alias("gone")))
    both = F.array(stretch("back", "ahead", False), F.when(again, stretch("back", "ahead", True)).otherwise(stretch("gone_back", "gone_ahead", True)))
    reached = (suffixes.select("doc_id", "key", "pos", "gram", "class").join(reach, ["gram", "class"])
               .select("doc_id", "key", first_id.alias("first_doc_id"), F.explode(F.filter(both, lambda x: x.isNotNull())).alias("_s"))
               .select("doc_id", "key", "first_doc_id", "_s.*"))
    line = Window.partitionBy("doc_id", "key", "gone").orderBy("start")
    new = F.col("start") > F.coalesce(F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    merged = (reached.withColumn("_new", new.cast("int")).withColumn("_stretch", F.sum("_new").over(line))
              .groupBy("doc_id", "key", "gone", "_stretch").agg(F.min("start").cast("bigint").alias("start"), F.max("end").cast("bigint").alias("end"), F.min("first_doc_id").alias("first_doc_id")))
    both = merged.groupBy("doc_id", "key").agg(   # as many as a text has stretches
        F.collect_list(F.when(~F.col("gone"), F.struct("start", "end", "first_doc_id"))).alias("_all"),
        F.array_sort(F.collect_list(F.when(F.col("gone"), F.struct("start", (F.col("end") - F.col("start")).alias("n_words"))))).alias("_gone"))
    return (both.withColumn("_s", F.explode("_all"))
            .select("doc_id", "key", F.col("_s.start").alias("start"), (F.col("_s.end") - F.col("_s.start")).alias("n_words"), F.col("_s.first_doc_id").alias("first_doc_id"),
                    F.filter("_gone", lambda g: (g["start"] >= F.col("_s.start")) & (g["start"] < F.col("_s.end"))).alias("removed")))


def cut_words(text: str, starts: list[int], counts: list[int]) -> str:
    """The text without stretches of words; a stretch takes the blanks after it along."""
    at = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)] + [len(text)]
    out, done = [], 0
    for s, n in sorted(zip(starts, counts, strict=True)):
        out.append(text[done:at[s]])
        done = max(done, at[s + n])
    return "".join([*out, text[done:]])


def without_repeats(docs: DataFrame, passage: Passage = Passage()) -> DataFrame:
    """``docs`` with clean_text: the text without its later copies of passages. A text without any comes back as it is, null stays null."""
    gone = (repeated_passages(docs, passage).groupBy("doc_id", "key").agg(F.flatten(F.collect_list("removed")).alias("_gone")).where(F.size("_gone") > 0)
           .select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "_gone"))

    def cut(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, start, n in columns:
            yield pa.array([t if s is None else cut_words(t, s, k) for t, s, k in zip(text.to_pylist(), start.to_pylist(), n.to_pylist(), strict=True)], pa.string())
    done = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key")), "left")
    return done.withColumn("clean_text", F.arrow_udf(cut, "string")(F.col("text"), F.col("_gone.start"), F.col("_gone.n_words"))).drop("_id", "_key", "_gone")
