"""Repeated spans of words by compaction of a De Bruijn graph.

Every window of ``window`` words is an edge between the nodes of its first and its last window - 1 words; an edge is told by the hashes of
both nodes, 128 bits. Only edges that stand in two documents matter. To find them without shuffling a row for each window:

1. A document whose text an earlier one has is a copy: it is told by a digest of its text, loses all its windows to that one and takes no
   further part. Each window of the others chooses the least of its short grams by hash. Equal windows choose equal grams, so a window whose gram no other
   document chose does not repeat. About one gram in five words is chosen; documents are counted for each.
2. Neighbouring windows that choose the same gram at the same place are one stretch, a row with its nodes. Equal stretches are merged before
   their edges are counted. An edge keeps its source: the first document and place where it stands. No two edges share a source.
3. A node with one repeated edge in and one out does not branch, and its two edges are on one path. Edges whose sources follow each
   other in one document are compacted first, to pieces; pieces are then joined to whole paths by doubling: each piece learns in a
   join what the piece before it reaches, so a path of n pieces takes log n rounds.
4. In each document, windows in a row with sources in a row are a span of a piece. Its words are verified against those at the
   source, digest against digest, before anything is removed. A span that differs, which two hashes of 64 bits leave no chance to, stays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.context import new_folder
from ledgerloom.llm.suffix_dedup import grams
from ledgerloom.llm.token_files import small_batches
from ledgerloom.llm.words import PORTION, hashed_portions

_EACH = "_doc", "_key"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back; the shuffle files of this one write are freed with it, since nothing reads them again."""
    spark = df.sparkSession
    before, path = spark.conf.get(FREE_SHUFFLES, "false"), new_folder(spark, name)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.scratch)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def chosen(words: np.ndarray, lengths: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For windows that lie in one text, in order: first word, place of the gram they choose - the leftmost of the least - and its hash."""
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(words))
    starts = np.flatnonzero(left >= window)
    g = grams(words, gram)
    best, at = g[starts], starts
    for j in range(1, window - gram + 1):
        other = g[starts + j]
        less = other < best
        best, at = np.where(less, other, best), np.where(less, starts + j, at)
    return starts, at, best


def _gram_rows(window: int, gram: int):
    """Of each text the grams that its windows choose, each once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, words, lengths in hashed_portions(b.column(2)):
                starts, at, g = chosen(words, lengths, window, gram)
                first = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.empty(0, np.int64)
                doc, g = np.searchsorted(np.cumsum(lengths), starts[first], "right"), g[first]
                order = np.lexsort((g, doc))
                doc, g = doc[order], g[order]
                new = np.append(True, (doc[1:] != doc[:-1]) | (g[1:] != g[:-1])) if len(g) else np.empty(0, bool)
                doc, g = doc[new], g[new]
                has = np.flatnonzero(np.bincount(doc, minlength=len(lengths)))
                ends = np.searchsorted(doc, has, "right")
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(g.view(np.int64)))
                take = pa.array(row + has)
                yield pa.RecordBatch.from_arrays([*[b.column(i).take(take) for i in (0, 1, 3)], lists], names=["_doc", "_key", "_digest", "grams"])
    return run


def _stretch_rows(window: int, gram: int):
    """Stretches of windows that choose one of the row's ``grams`` at one place: first word and hashes of the nodes along it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            wanted, sizes = b.column(3).flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.asarray(b.column(3).value_lengths())
            ends = np.cumsum(sizes)
            for row, words, lengths in hashed_portions(b.column(2)):
                starts, at, g = chosen(words, lengths, window, gram)
                doc = np.searchsorted(np.cumsum(lengths), starts, "right")
                mine = slice(ends[row] - sizes[row], ends[row + len(lengths) - 1])
                kept = np.isin(g, wanted[mine])   # a gram that only another row of the run shares does no harm
                starts, at, doc = starts[kept], at[kept], doc[kept]
                if not len(starts):
                    continue
                first = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)))
                n = np.diff(np.append(first, len(starts)))
                node = grams(words, window - 1)
                begin = starts[first]
                spread = np.repeat(begin, n + 1) + np.arange((n + 1).sum()) - np.repeat(np.cumsum(n + 1) - (n + 1), n + 1)
                nodes = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n + 1)).astype(np.int32)), pa.array(node[spread].view(np.int64)))
                place = (begin - (np.cumsum(lengths) - lengths)[doc[first]]).astype(np.int32)
                take = pa.array(row + doc[first])
                yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(place), nodes], names=["_doc", "_key", "pos", "nodes"])
    return run


def _texts(docs: DataFrame) -> DataFrame:
    """A row is told by its doc_id, the least where it is null, and a hash of its text: equal rows are one."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(F.unhex(F.md5(text)).alias("_digest"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("_doc"), F.xxhash64("text").alias("_key"), text.alias("_text"), F.col("doc_id").cast("bigint").alias("doc_id"))


class Graph:
    """The repeated edges of ``docs``, their paths, and the documents' spans on them; all tables are written once."""

    def __init__(self, docs: DataFrame, window: int = 13, gram: int = 5):
        small_batches(docs.sparkSession)
        self.window, self.texts = window, _texts(docs)
        plain = self.texts.select("_doc", "_key", "_text")
        found = "_doc bigint, _key bigint, _digest binary, grams array<bigint>"
        grams_of = written(self.texts.select("_doc", "_key", "_text", "_digest").mapInArrow(_gram_rows(window, gram), found), "bruijn-grams")
        firsts = written(grams_of.groupBy("_digest").agg(F.min("_doc").alias("_first")), "bruijn-firsts")   # of texts that have a window
        known = written(grams_of.select("_doc", "_key", "_digest").join(firsts, "_digest").select("_doc", "_key", (F.col("_doc") > F.col("_first")).alias("copy")).distinct(), "bruijn-rows")
        self.copies = known.where("copy").select(*_EACH)
        long_ = grams_of.join(known.where("NOT copy"), [*_EACH], "left_semi").select("_doc", "_key", F.explode("grams").alias("gram"))
        shared = written(long_.groupBy("gram").count().where("count > 1").select("gram"), "bruijn-shared")
        hits = written(long_.join(shared, "gram", "left_semi").groupBy("_doc", "_key").agg(F.collect_set("gram").alias("grams")), "bruijn-hits")
        stretch = "_doc bigint, _key bigint, pos int, nodes array<bigint>"
        # rows that are equal in doc_id and text give the same stretches, which the merge below counts once
        self.stretches = written(plain.join(hits, [*_EACH]).mapInArrow(_stretch_rows(window, gram), stretch), "bruijn-stretches")
        self.known = known
        discard(grams_of, firsts, shared, hits)
        at = F.struct("_doc", "_key", "pos")
        merged = self._told_apart(self.stretches).groupBy("a", "b", "n").agg(F.min(at).alias("at"), F.max("_doc").alias("last"), F.first("nodes").alias("nodes"))
        self.classes = written(merged.select("a", "b", "n", F.col("at._doc").alias("f_doc"), F.col("at._key").alias("f_key"), F.col("at.pos").alias("f_pos"), "last", "nodes"), "bruijn-classes")
        self.edges = self._edges()
        self.placed, self.pieces = self._pieces()
        self.paths = self._paths()

    @staticmethod
    def _told_apart(stretches: DataFrame) -> DataFrame:
        """A stretch's words are told by its first and last node, which overlap, and by its length, as words may go round in a circle."""
        return stretches.select("*", F.col("nodes")[0].alias("a"), F.element_at("nodes", -1).alias("b"), F.size("nodes").alias("n"))

    def _windows(self) -> DataFrame:
        """The edges of every class of stretches with their number in it."""
        each = F.transform(F.sequence(F.lit(0), F.size("nodes") - 2), lambda i: F.struct(i.alias("i"), F.get("nodes", i).alias("u"), F.get("nodes", i + 1).alias("v")))
        return self.classes.select("a", "b", "n", "f_doc", "f_key", "f_pos", "last", F.explode(each).alias("w")).select(
            "a", "b", "n", "f_doc", "f_key", (F.col("f_pos") + F.col("w.i")).alias("f_pos"), "last", "w.i", "w.u", "w.v")

    def _edges(self) -> DataFrame:
        """``u, v, f_doc, f_key, f_pos``: edges that stand in two documents or more, with their source. Where an edge stands more than once
        in its first document, key and place are of one and the same row."""
        found = self._windows().groupBy("u", "v").agg(F.min("f_doc").alias("d"), F.min_by("f_key", "f_doc").alias("f_key"), F.min_by("f_pos", "f_doc").alias("f_pos"), F.max("last").alias("last"))
        return written(found.where("d < last").select("u", "v", F.col("d").alias("f_doc"), "f_key", "f_pos"), "bruijn-edges")

    def _pieces(self) -> tuple[DataFrame, DataFrame]:
        """Edges with the ``head`` of their piece, and ``f_doc, f_key, head, n, b_doc, b_key, b_pos``: runs of edges on one path with sources
        in a row; the last three tell the source of the edge ahead of the first."""
        none = [F.lit(None).cast(t).alias(x) for x, t in (("d", "bigint"), ("k", "bigint"), ("p", "int"))]
        at = F.struct(F.col("f_doc").alias("d"), F.col("f_key").alias("k"), F.col("f_pos").alias("p"))
        sides = F.explode(F.array(F.struct(F.col("v").alias("node"), at.alias("into"), F.struct(*none).alias("out")), F.struct(F.col("u").alias("node"), F.struct(*none).alias("into"), at.alias("out")))).alias("s")
        flat = self.edges.select(sides).select("s.node", *[F.col(f"s.{side}.{x}").alias(f"{side}_{x}") for side in ("into", "out") for x in "dkp"])
        nodes = flat.groupBy("node").agg(F.count("into_d").alias("ins"), F.count("out_d").alias("outs"), *[F.max(c).alias(c) for c in flat.columns[1:]])
        single = nodes.where("ins = 1 AND outs = 1 AND NOT (into_d = out_d AND into_k = out_k AND into_p = out_p)")   # of one value the maximum is that value
        links = single.select(F.col("out_d").alias("f_doc"), F.col("out_k").alias("f_key"), F.col("out_p").alias("f_pos"), F.col("into_d").alias("b_doc"), F.col("into_k").alias("b_key"), F.col("into_p").alias("b_pos"))
        marked = self.edges.join(links, ["f_doc", "f_key", "f_pos"], "left")
        follows = F.coalesce((F.col("b_doc") == F.col("f_doc")) & (F.col("b_key") == F.col("f_key")) & (F.col("b_pos") == F.col("f_pos") - 1), F.lit(False))
        line = Window.partitionBy("f_doc", "f_key").orderBy("f_pos").rowsBetween(Window.unboundedPreceding, 0)
        headed = marked.withColumn("head", F.last(F.when(~follows, F.col("f_pos")), ignorenulls=True).over(line))
        first = F.col("f_pos") == F.col("head")
        placed = written(headed.select("u", "v", "f_doc", "f_key", "f_pos", "head", *[F.when(first, F.col(c)).alias(c) for c in ("b_doc", "b_key", "b_pos")]), "bruijn-placed")
        pieces = placed.groupBy("f_doc", "f_key", "head").agg(F.count(F.lit(1)).cast("int").alias("n"), *[F.max(c).alias(c) for c in ("b_doc", "b_key", "b_pos")])
        return placed, written(pieces, "bruijn-pieces")

    def _paths(self) -> DataFrame:
        """``f_doc, f_key, head, path, skipped``: for every piece the source of its path's first edge and the path's edges ahead of the piece."""
        own = F.struct(F.col("f_doc").alias("d"), F.col("f_key").alias("k"), F.col("head").alias("p"))
        tails = self.pieces.select(F.col("f_doc").alias("b_doc"), F.col("f_key").alias("b_key"), (F.col("head") + F.col("n") - 1).alias("b_pos"), own.alias("to"), F.col("n").cast("bigint").alias("skipped"))
        start = self.pieces.select(own.alias("piece"), "b_doc", "b_key", "b_pos").join(tails, ["b_doc", "b_key", "b_pos"], "left").select(
            "piece", F.coalesce("to", "piece").alias("to"), F.coalesce("skipped", F.lit(0)).alias("skipped"), F.col("to").isNotNull().alias("open"))
        state = written(start, "bruijn-reach")
        rounds = max(1, state.count()).bit_length() + 1
        for _ in range(rounds):
            if state.where("open").limit(1).count() == 0:
                break
            there = state.select(F.col("piece").alias("_piece"), F.col("to").alias("_to"), F.col("skipped").alias("_skipped"), F.col("open").alias("_open"))
            moved = state.where("open").join(there, F.col("to") == F.col("_piece")).select("piece", F.col("_to").alias("to"), (F.col("skipped") + F.col("_skipped")).alias("skipped"), F.col("_open").alias("open"))
            last, state = state, written(moved.unionByName(state.where("NOT open")), "bruijn-reach")
            discard(last)
        # what is still open goes round in a circle: each piece of it is a path of its own
        return state.select(F.col("piece.d").alias("f_doc"), F.col("piece.k").alias("f_key"), F.col("piece.p").alias("head"),
                            F.when(F.col("open"), F.col("piece")).otherwise(F.col("to")).alias("path"), F.when(F.col("open"), 0).otherwise(F.col("skipped")).alias("skipped"))

    def spans(self) -> DataFrame:
        """``_doc, _key, start, n_words, f_doc, f_key, f_pos, path, path_at``: runs of words that stand in a document with a smaller doc_id, where they
        stand there, and on which path and how many edges into it. Spans may overlap where paths branch."""
        w = self._windows().select("a", "b", "n", "i", "u", "v")
        found = w.join(self.placed.select("u", "v", "f_doc", "f_key", "f_pos", "head"), ["u", "v"]).groupBy("a", "b", "n").agg(
            F.collect_list(F.struct("i", "f_doc", "f_key", "f_pos", "head")).alias("found"), F.min("f_doc").alias("least"))
        met = self._told_apart(self.stretches).select("_doc", "_key", "pos", "a", "b", "n").join(written(found, "bruijn-found"), ["a", "b", "n"]).where("least < _doc")
        rows = met.select("_doc", "_key", "pos", F.explode("found").alias("e")).where("e.f_doc < _doc").select("_doc", "_key", (F.col("pos") + F.col("e.i")).alias("p"), "e.f_doc", "e.f_key", "e.f_pos", "e.head")
        same = ["_doc", "_key", "f_doc", "f_key", "head", "shift"]
        line = rows.withColumn("shift", F.col("f_pos") - F.col("p"))
        # equal rows of the input bring each window as often as they are there: their numbers are the same
        line = line.withColumn("run", F.col("p") - F.dense_rank().over(Window.partitionBy(*same).orderBy("p")))
        spans = line.groupBy(*same, "run").agg(F.min("p").alias("start"), (F.max("p") - F.min("p") + self.window).cast("int").alias("n_words"), F.min("f_pos").alias("f_pos"))
        return spans.join(self.paths, ["f_doc", "f_key", "head"]).select("_doc", "_key", "start", "n_words", "f_doc", "f_key", "f_pos", "path", (F.col("skipped") + F.col("f_pos") - F.col("head")).alias("path_at"))


def _span_digest(words: list[bytes], start: int, n: int) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words[start:start + n]))


def _source_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["f_doc", "f_key", "f_pos", "n_words", "digest"]
    for b in batches:
        for i in range(b.num_rows):
            words = b.column(2)[i].as_py().split()
            at = b.column(3)[i].values
            pos, n = at.field("f_pos"), at.field("n_words")
            found = [_span_digest(words, p, m) for p, m in zip(pos.to_pylist(), n.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.repeat(b.column(0)[i], len(found)), pa.repeat(b.column(1)[i], len(found)), pos, n, pa.array(found, pa.binary())], names=names)


_CLEANED = "doc_id bigint, n_words bigint, n_removed bigint, n_paths bigint, kept string"


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows, held = [], 0
        for doc_id, text, spans, copy in zip(*b.columns, strict=True):
            words = text.as_py().split()
            gone = np.zeros(len(words) + 1, np.int64)
            paths = set()
            for s in spans.as_py() or ():
                if _span_digest(words, s["start"], s["n_words"]) == s["digest"]:
                    gone[s["start"]] += 1
                    gone[s["start"] + s["n_words"]] -= 1
                    paths.add(tuple(s["path"].values()))
            covered = np.full(len(words), True) if copy.as_py() else np.cumsum(gone[:-1]) > 0
            kept = b" ".join([words[i] for i in np.flatnonzero(~covered)] if covered.any() else words)
            rows.append((doc_id.as_py(), len(words), int(covered.sum()), len(paths), kept))
            held += len(kept)
            if held > PORTION:
                yield _cleaned_batch(rows)
                rows, held = [], 0
        if rows:
            yield _cleaned_batch(rows)


def _cleaned_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.binary()).cast(pa.string())], names=[c.split()[0] for c in _CLEANED.split(", ")])


def without_repeats(docs: DataFrame, window: int = 13, gram: int = 5) -> DataFrame:
    """``doc_id, n_words, n_removed, n_paths, kept`` for every row of ``docs`` (doc_id, text): words that a window covers which also starts in a
    document with a smaller doc_id are removed, ``kept`` holds the others with one space between them, and ``n_paths`` counts the
    paths of the graph they are from; a copy of a whole earlier text is on none.

    Windows are judged on the input, whatever is removed. Repeats inside a document, or between rows of one doc_id, are no repeats. A null doc_id is
    the smallest of all, so its words stay. A null or blank text has no words; a text shorter than a window loses none. Equal rows get equal results.
    An empty table gives no rows. Other columns are not read."""
    graph = Graph(docs, window, gram)
    spans = written(graph.spans(), "bruijn-spans")
    discard(graph.stretches, graph.classes, graph.edges, graph.placed, graph.pieces)
    asked = spans.select("f_doc", "f_key", "f_pos", "n_words").distinct().groupBy("f_doc", "f_key").agg(F.collect_list(F.struct("f_pos", "n_words")).alias("at"))
    there = graph.texts.join(asked, (F.col("_doc") == F.col("f_doc")) & (F.col("_key") == F.col("f_key"))).select("f_doc", "f_key", "_text", "at")
    digests = written(there.mapInArrow(_source_digests, "f_doc bigint, f_key bigint, f_pos int, n_words int, digest binary"), "bruijn-digests").distinct()
    told = spans.join(digests, ["f_doc", "f_key", "f_pos", "n_words"]).groupBy("_doc", "_key").agg(F.collect_list(F.struct("start", "n_words", "digest", "path")).alias("spans"))
    told = written(told.withColumn("copy", F.lit(False)).unionByName(graph.copies.withColumn("copy", F.lit(True)), allowMissingColumns=True), "bruijn-told")
    rows = graph.texts.join(told.withColumnsRenamed({"_doc": "_d", "_key": "_k"}), (F.col("_doc") == F.col("_d")) & (F.col("_key") == F.col("_k")), "left")
    return rows.select("doc_id", "_text", "spans", F.coalesce("copy", F.lit(False)).alias("copy")).mapInArrow(_cleaned, _CLEANED)


def text_digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
