"""A stored SCD-2 history whose closed versions are written once.

    <folder>/open/run=<n>/_bucket=<b>/     open versions of the keys of bucket b, as run n left them
    <folder>/closed/run=<n>/closed_on=<d>/ versions that run n closed, by the day they ended
    <folder>/runs/<n>/                     one row: the run's batch, its columns, and for each bucket the run that wrote it last

A run reads the open versions, rewrites the buckets of keys that changed and adds the versions that ended. It is published
by its row below ``runs``, written last. A run that dies before that changes nothing that readers see, and is repeated under the
same number; a batch that is already published is not applied again. Every earlier state stays readable by its number."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ledgerloom.context import checkpointed
from ledgerloom.functions.keys import differs
from ledgerloom.operators.ordered import first_per_key, hot_keys, neighbours

_RUN = "run bigint, batch string, columns string, buckets array<struct<bucket: int, run: bigint>>"


@dataclass(frozen=True)
class _Run:
    number: int
    schema: T.StructType      # of open versions: the source's columns and valid_from
    buckets: dict[int, int]   # the run that wrote each bucket last


@dataclass
class HistoryStore:
    """Row histories of one relation, by ``key``. ``buckets`` is fixed when the store is made: about the number of open versions over
    what one task should rewrite."""

    spark: SparkSession
    folder: str
    key: str
    buckets: int = 64

    def _rows_of_runs(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_RUN).json(os.path.join(self.folder, "runs", "*"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def published(self, run: int | None = None) -> _Run | None:
        """The newest run, or the one of that number; None in a new store."""
        rows = self._rows_of_runs()
        if rows is None:
            return None
        found = (rows.orderBy(F.desc("run")) if run is None else rows.where(F.col("run") == run)).limit(1).collect()
        if not found:
            return None
        return _Run(found[0]["run"], T.StructType.fromJson(json.loads(found[0]["columns"])), {b["bucket"]: b["run"] for b in found[0]["buckets"]})

    def is_applied(self, batch: str) -> bool:
        rows = self._rows_of_runs()
        return rows is not None and rows.where(F.col("batch") == batch).limit(1).count() > 0

    def _open(self, state: _Run, only: set[int] | None = None) -> DataFrame:
        paths = [os.path.join(self.folder, "open", f"run={r}", f"_bucket={b}") for b, r in state.buckets.items() if only is None or b in only]
        if not paths:
            return self.spark.createDataFrame([], state.schema)
        return self.spark.read.schema(state.schema).parquet(*paths)

    def history(self, run: int | None = None) -> DataFrame:
        """All versions as that run (the newest unless given) left them; ``valid_to`` is NULL while a version is open."""
        state = self.published(run)
        if state is None:
            raise ValueError("nothing published")
        end = F.lit(None).cast(state.schema["valid_from"].dataType).alias("valid_to")
        now = self._open(state).select("*", end)
        whole = T.StructType([*state.schema.fields, T.StructField("valid_to", state.schema["valid_from"].dataType), T.StructField("run", T.LongType())])
        try:
            ended = self.spark.read.schema(whole).parquet(os.path.join(self.folder, "closed")).where(F.col("run") <= state.number)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return now
        return now.unionByName(ended.select(*now.columns))

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.buckets)).cast("int")

    def apply(self, changes: DataFrame, at: Column, batch: str) -> int:
        """Versions from rows that changed: each starts one at its time ``at``, an expression, and ends the one before. A key may change more than once in a
        batch; rows no newer than the key's open version are ignored, of rows of one key and time one counts. Keys that are not in
        ``changes`` stay as they are. A column that one side lacks is NULL there. Returns the number of the published run."""
        state = self.published()
        if state is not None and self.is_applied(batch):
            return state.number
        key, number = self.key, (state.number if state else 0) + 1
        rows = changes.where(F.col(key).isNotNull()).withColumn("valid_from", at)
        kinds = {f.name: f.dataType for f in (state.schema.fields if state else [])}
        for f in rows.schema.fields:
            kinds.setdefault(f.name, f.dataType)
        names = [n for n in kinds if n != "valid_from"] + ["valid_from"]

        def shaped(df: DataFrame) -> DataFrame:
            return df.select(*[(F.col(f"`{n}`") if n in df.columns else F.lit(None)).cast(kinds[n]).alias(n) for n in names])
        fresh = first_per_key(shaped(rows), [key, "valid_from"], [])
        if state is not None:
            known = self._open(state).select(F.col(key).alias("_k"), F.col("valid_from").alias("_since"))
            fresh = fresh.join(known, F.col(key) == F.col("_k"), "left").where("_since IS NULL OR valid_from > _since").drop("_k", "_since")
        fresh = checkpointed(fresh.withColumn("_bucket", self._bucket(F.col(key))))
        touched = {r["_bucket"] for r in fresh.select("_bucket").distinct().collect()}   # at most ``buckets`` numbers
        keys = fresh.select(F.col(key).alias("_k")).distinct()
        line, kept = fresh.drop("_bucket"), None
        if state is not None and touched:
            before = shaped(self._open(state, touched))
            line = line.unionByName(before.join(keys, F.col(key) == F.col("_k"), "left_semi"))
            kept = before.join(keys, F.col(key) == F.col("_k"), "left_anti")
        line = checkpointed(neighbours(line, [key], ["valid_from"], hot_keys(key, line), following={"valid_to": "valid_from"}))
        ended = line.where("valid_to IS NOT NULL").withColumn("closed_on", F.col("valid_to").cast("date"))
        now = line.where("valid_to IS NULL").drop("valid_to")
        now = now if kept is None else now.unionByName(kept)
        ended.write.mode("overwrite").partitionBy("closed_on").parquet(os.path.join(self.folder, "closed", f"run={number}"))
        out = now.withColumn("_bucket", self._bucket(F.col(key))).repartition("_bucket")
        out.write.mode("overwrite").partitionBy("_bucket").parquet(os.path.join(self.folder, "open", f"run={number}"))
        written = {**(state.buckets if state else {}), **{b: number for b in touched}}
        schema = T.StructType([T.StructField(n, kinds[n]) for n in names])
        row = [(number, batch, json.dumps(schema.jsonValue()), sorted(written.items()))]
        self.spark.createDataFrame(row, _RUN).coalesce(1).write.mode("overwrite").json(os.path.join(self.folder, "runs", str(number)))
        return number

    def apply_state(self, current: DataFrame, compared: list[str], at: Column, batch: str) -> int:
        """Versions from a whole current state without change times: a row that differs from its open version in any of ``compared``
        (NULL-safe), or has none, starts one at ``at``. Keys that vanished stay open."""
        state = self.published()
        rows = current
        if state is not None:
            old = self._open(state)
            old = old.select(F.col(self.key).alias("_k"), *[(F.col(x) if x in old.columns else F.lit(None)).alias("_old_" + x) for x in compared])
            changed = differs([F.col(x) for x in compared], [F.col("_old_" + x) for x in compared])
            rows = rows.join(old, F.col(self.key) == F.col("_k"), "left").where(F.col("_k").isNull() | changed).select(*current.columns)
        return self.apply(rows, at, batch)

    def follow(self, stream: DataFrame, at: Column, checkpoint: str) -> None:
        """Applies what a change stream holds, micro-batch by micro-batch, then stops. A batch is known by its number, so one that is
        replayed after a failure is not applied twice."""
        def merge(batch: DataFrame, number: int) -> None:
            self.apply(checkpointed(batch), at, f"stream-{number}")
        stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
