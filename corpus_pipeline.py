"""Corpus pipeline: from raw documents to token ids, in stages that are each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and works on all rows it gets; all but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.context import tune
from ledgerloom.llm import bpe, language, line_dedup, mixing, simhash
from ledgerloom.llm.common import documents, stored, word_count


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose language the model rejects, texts without a letter among them. The model learns from the
    labelled documents that are not held out. A missing lang is filled with the prediction; a given one stays."""
    model = language.fit(docs.where(~language.held_out()).select("text", "lang"))
    known = language.predict(docs.withColumn("_row", F.struct(*docs.columns)).select("_row"), model, F.col("_row.text")).where("NOT rejected")
    return known.select(*[F.coalesce(F.col("_row.lang"), F.col("lang_pred")).alias(c) if c == "lang" else F.col("_row")[c].alias(c) for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of repeated runs of lines: one line or more with eight words in all, blank lines not counted, since
    shorter ones repeat by chance. Documents of which nothing but blanks is left go. n_chars follows the text."""
    row = docs.withColumn("_row", F.struct(*docs.columns)).select("doc_id", "text", "_row")
    done = line_dedup.dedup_lines(row, run_words=8).where((F.col("n_lines_removed") == 0) | (word_count(F.col("clean_text")) > 0))
    new = {"text": F.col("clean_text"), "n_chars": F.when(F.col("n_lines_removed") == 0, F.col("_row")["n_chars"]).otherwise(F.length("clean_text").cast("bigint"))}
    return done.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that SimHash links: the one of least doc_id. Three-word shingles, at most 3 of 64 bits."""
    return simhash.first_of_groups(docs, radius=3, shingle=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents so that each source's words come near its target."""
    return mixing.mixed(docs, word_count(F.col("text")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of the text decoded from them, which is the text's own."""
    return bpe.encode_checked(docs.select("doc_id", "source", "lang", "text")).select("doc_id", "source", "lang", "n_tokens", "ids", "decoded_sha256")


STAGES = [("language ID", identify_language), ("line dedup", dedup_lines), ("near dedup", dedup_near), ("source mix", mix_sources), ("BPE", encode)]

#: Language scores and hash-based groups are not expressible in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. Each stage's rows are written to the shared folder before the next reads them."""
    docs = documents(tune(spark), sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
