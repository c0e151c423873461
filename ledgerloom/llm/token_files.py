"""Token ids in ORC files: documents in order, integers run-length encoded, row indexes and Bloom filters on doc_id."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.context import tune
from ledgerloom.llm.tokens import WIDTH, WordTokens, kept, tokenizer_path

SCHEMA = "doc_id bigint, start_in_file bigint, n_tokens bigint, ids array<int>"
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds what a Python task holds at once; long texts count by their bytes."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 * BATCH_BYTES))


def portions(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch in runs of few rows, so that what is cut and encoded at once stays small."""
    return (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


def _encoder(name: str, end_id: int):
    end = np.asarray([end_id], "<u4").tobytes()

    def batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        sizes = [len(ids) // WIDTH for _, _, ids in rows]
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        values = pa.Array.from_buffers(pa.int32(), int(sum(sizes)), [None, pa.py_buffer(b"".join(ids for _, _, ids in rows))])
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                           pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, values)],
                                          names=["doc_id", "start_in_file", "n_tokens", "ids"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = kept(WordTokens, tokenizer_path(name))
        start, rows, held = 0, [], 0
        for b in batches:
            for part in portions(b):
                for doc_id, ids in zip(part.column(0).to_pylist(), tokens.encode_all(part.column(1).to_pylist()), strict=True):
                    rows.append((doc_id, start, ids + end))
                    start, held = start + len(ids) // WIDTH + 1, held + len(ids)
                if held > BATCH_BYTES:
                    yield batch(rows)
                    rows, held = [], 0
        if rows:
            yield batch(rows)
    return encode


def write_token_files(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 1,
                      stripe_bytes: int = 64 << 20, bloom_fpp: float = 0.01) -> None:
    """Encodes ``docs`` (doc_id, text) and writes ORC files below ``path``; file after file and row after row ascend by doc_id.

    A null or blank text gives the end id alone; a null doc_id comes first; rows that share a doc_id stand together, in order
    of their texts. An empty table gives no rows. Other columns are not read. Numbers are stored by ORC's run-length
    encoding (version 2) and a general codec on top; each stripe has row indexes (minimum, maximum per 10,000 rows) and
    a Bloom filter on doc_id, so a look-up reads few stripes and splits can be read side by side. Ranges hold equal numbers
    of documents; each is sorted and encoded by one task, which never holds more than a batch."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    (rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(_encoder(tokenizer, end_id), SCHEMA)
     .write.options(**{"compression": "zstd", "orc.create.index": "true", "orc.row.index.stride": "10000", "orc.stripe.size": str(stripe_bytes),
                       "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": str(bloom_fpp)}).orc(path))


def read_token_files(spark: SparkSession, path: str, which: Column | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids``: rows of the files, with the number of ids of all documents before each.

    ``which``, a condition on doc_id, reaches the files' indexes and Bloom filters. The totals that turn a start within
    a file into one within the corpus come from n_tokens alone, one row per file."""
    rows = spark.read.schema(SCHEMA).orc(path).withColumn("_file", F.col("_metadata.file_name"))
    number = F.regexp_extract("_file", r"^part-(\d+)", 1).cast("bigint")
    before = F.sum("_n").over(Window.orderBy(number).rowsBetween(Window.unboundedPreceding, -1))
    files = rows.groupBy("_file").agg(F.sum("n_tokens").alias("_n")).select("_file", F.coalesce(before, F.lit(0)).alias("_before"))
    found = rows if which is None else rows.where(which)
    return (found.join(F.broadcast(files), "_file")   # one row per file
            .select("doc_id", (F.col("_before") + F.col("start_in_file")).alias("start"), "n_tokens", "ids"))


def checksums(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of rows read back: crc32 of the ids as little-endian unsigned 32-bit integers."""
    small_batches(tokens.sparkSession)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(3)
            ends, values = np.asarray(ids.offsets), memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            crc = [zlib.crc32(values[WIDTH * int(x):WIDTH * int(y)]) for x, y in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(sums, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
