"""Token totals kept up to date by signed changes, committed once per batch."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored
from ledgerloom.llm.token_files import small_batches
from ledgerloom.llm.tokens import WordTokens, kept, tokenizer_path

KEY = ["doc_id", "tokenizer"]
FEED = "doc_id bigint, source string, lang string, tokenizer string, op string, n_tokens bigint, seq bigint"
CHANGES = "doc_id bigint, tokenizer string, source string, lang string, n_tokens bigint, sign int"
TOTALS = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"


def word_tokens(text: Column, tokenizer: str = "word_bpe_49k.json") -> Column:
    """Tokens of a text under a tokenizer of the library that drops white space; a null text has none."""
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = kept(WordTokens, tokenizer_path(tokenizer))
        for batch in texts:
            yield pa.array(tokens.count_all(batch.to_pylist()), pa.int64())
    return F.arrow_udf(run, "bigint")(F.coalesce(text, F.lit("")).cast("binary"))


class _Ranks:
    """Counts by the tiktoken library, whose ranks are the ids of the same vocabulary. Special strings count as one token each."""

    def __init__(self, path: str, specials: tuple[str, ...]):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.specials = re.compile("|".join(map(re.escape, specials)))

    def count(self, text: str) -> int:
        parts = self.specials.split(text)
        return len(parts) - 1 + sum(len(self.encoding.encode_ordinary(p)) for p in parts if p)


def byte_tokens(text: Column, tokenizer: str = "byte_bpe_50k.tiktoken", specials: tuple[str, ...] = ("<|endoftext|>",)) -> Column:
    """Tokens of a text under byte-level BPE; a null text has none."""
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranks = kept(_Ranks, tokenizer_path(tokenizer), specials)
        for batch in texts:
            yield pa.array([ranks.count(t.as_py() or "") for t in batch], pa.int64())
    return F.arrow_udf(run, "bigint")(text)


class TokenRollup:
    """Totals by source, language and tokenizer version below ``path``, a folder that all executors share.

    ``changes/batch=B`` holds signed rows of single documents, ``totals/batch=B`` their sums, and ``commits/batch=B`` is written
    last: a batch counts once its commit is there. A run that died before is done again over its own leftovers; a batch
    that is committed is not applied again, so a repeated call changes nothing. Batches are applied one after another by one
    writer. Totals add up over batches, so a reader sums small rows and never counts documents again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        small_batches(spark)

    def _at(self, kind: str, batch: str) -> str:
        return os.path.join(self.path, kind, f"batch={batch}")

    def batches(self) -> list[str]:
        """Committed batches: one small row each."""
        try:
            found = self.spark.read.schema("batch string").json(os.path.join(self.path, "commits", "batch=*"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(r["batch"] for r in found.collect())

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [self._at(kind, b) for b in self.batches()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def live(self) -> DataFrame:
        """The documents that count now: doc_id, tokenizer, source, lang, n_tokens."""
        values = ["doc_id", "tokenizer", "source", "lang", "n_tokens"]
        return self._read("changes", CHANGES).groupBy(*values).agg(F.sum("sign").alias("_n")).where("_n > 0").drop("_n")

    def apply(self, batch: str, feed: DataFrame) -> bool:
        """Applies a feed (``FEED``) as one batch; False if it was committed before.

        op is insert, revise or delete. An insert or revision sets the document's source, language and count, whatever it
        was before; a delete takes it out; a delete of an unknown document does nothing. Of several rows for one (doc_id,
        tokenizer) the highest seq counts, among equals the greatest row. A null n_tokens counts as 0. Null keys and null
        sources or languages are values like others; rows with an unknown op raise an error."""
        if batch in self.batches():
            return False
        order = ["seq", "op", "n_tokens", "source", "lang"]
        op = F.when(F.col("op").isin("insert", "revise", "delete"), F.col("op")).otherwise(F.raise_error(F.concat(F.lit("unknown op: "), F.coalesce("op", F.lit("null")))))
        last = feed.withColumn("op", op).groupBy(*KEY).agg(F.max(F.struct(*order)).alias("_new"))
        old = self.live().select(*KEY, F.struct("source", "lang", "n_tokens").alias("_old"))
        same = F.col("l.doc_id").eqNullSafe(F.col("o.doc_id")) & F.col("l.tokenizer").eqNullSafe(F.col("o.tokenizer"))
        both = last.alias("l").join(old.alias("o"), same, "left").select("l.doc_id", "l.tokenizer", "_new", "_old")
        row = lambda x, sign: F.struct(F.col(f"{x}.source").alias("source"), F.col(f"{x}.lang").alias("lang"),
                                       F.coalesce(F.col(f"{x}.n_tokens"), F.lit(0)).cast("bigint").alias("n_tokens"), F.lit(sign).alias("sign"))
        signed = F.array(F.when(F.col("_old").isNotNull(), row("_old", -1)), F.when(F.col("_new.op") != "delete", row("_new", 1)))
        changed = both.select(*KEY, F.explode(F.filter(signed, lambda x: x.isNotNull())).alias("_s")).select(*KEY, "_s.*")
        changed.select(*[c.split()[0] for c in CHANGES.split(", ")]).write.mode("overwrite").parquet(self._at("changes", batch))
        rows = self.spark.read.schema(CHANGES).parquet(self._at("changes", batch))
        (rows.groupBy("source", "lang", "tokenizer").agg(F.sum("sign").cast("bigint").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens"))
         .write.mode("overwrite").parquet(self._at("totals", batch)))
        self.spark.createDataFrame([(batch,)], "batch string").write.mode("overwrite").json(self._at("commits", batch))
        return True

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, n_docs, n_tokens`` over all committed batches; groups without documents are left out."""
        return (self._read("totals", TOTALS).groupBy("source", "lang", "tokenizer")
                .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0"))


def without_repeated_lines(text: Column) -> Column:
    """The text with every line that equals an earlier one left out."""
    return F.array_join(F.array_distinct(F.split(text, "\n", -1)), "\n")


def copies(docs: DataFrame) -> DataFrame:
    """doc_id of every document whose text an earlier doc_id has. Texts meet by their digest, the first one of each found by a
    combining aggregate."""
    keyed = docs.where("text_key IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text_key")
    first = stored(keyed.groupBy("text_key").agg(F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1"), "text-firsts")
    return keyed.join(first, "text_key").where("doc_id > _first").select("doc_id")

