"""SCD-2 snapshots: history + current state -> new history, in one full outer join.

Closed versions pass through untouched; columns of either side stay. An open version meets the current row of its key and yields
itself, or itself closed plus a new open version. Keys that vanished stay open; ``drop_deleted`` is the
operator that removes them. Results go to a new folder, never over the history being read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.keys import differs


def _merge(prev: DataFrame, cur: DataFrame, key: str, is_newer: Callable[[Column, Column], Column],
           starts: Callable[[Column], Column]) -> DataFrame:
    versioned = [x for x in prev.columns if x not in ("valid_from", "valid_to")]
    cols = versioned + [x for x in cur.columns if x not in versioned]
    # a column that one side lacks is NULL there: neither a dropped nor a new source column touches closed versions
    prev = prev.select("*", *[F.lit(None).cast(cur.schema[x].dataType).alias(x) for x in cur.columns if x not in versioned])
    twice = F.count(F.lit(1)).over(Window.partitionBy(key)) > 1   # the merge needs this partitioning anyway
    cur = (cur.select("*", *[F.lit(None).cast(prev.schema[x].dataType).alias(x) for x in versioned if x not in cur.columns])
           .withColumn(key, F.when(F.col(key).isNotNull() & twice, F.raise_error(F.concat(F.lit("key occurs twice in the current state: "), F.col(key).cast("string"))).cast(cur.schema[key].dataType))
                       .otherwise(F.col(key))))
    closed = prev.where(F.col("valid_to").isNotNull()).select(*cols, "valid_from", "valid_to")
    old = prev.where(F.col("valid_to").isNull()).select(
        F.col(key).alias("_pk"), F.struct(*cols, "valid_from").alias("_old"))
    new = cur.select(F.col(key).alias("_ck"), F.struct(*cols).alias("_new"))
    o, n = F.col("_old"), F.col("_new")

    def version(row: Column, start: Column, end: Column) -> Column:
        return F.struct(*[row[c].alias(c) for c in cols], start.alias("valid_from"), end.alias("valid_to"))

    start = starts(n)
    never = F.lit(None).cast(prev.schema["valid_to"].dataType)
    kept, opened = version(o, o["valid_from"], never), version(n, start, never)
    ended = version(o, o["valid_from"], start)
    pieces = (F.when(n.isNull(), F.array(kept)).when(o.isNull(), F.array(opened))
              .when(is_newer(o, n), F.array(ended, opened)).otherwise(F.array(kept)))
    merged = old.join(new, F.col("_pk") == F.col("_ck"), "full").select(F.explode(pieces).alias("v")).select("v.*")
    return closed.unionByName(merged)


def snapshot_timestamp(prev: DataFrame, cur: DataFrame, key: str, updated_at: str) -> DataFrame:
    """A row updated later than its open version starts a new one at that time."""
    return _merge(prev, cur, key, lambda o, n: n[updated_at] > o["valid_from"], lambda n: n[updated_at])


def snapshot_check(prev: DataFrame, cur: DataFrame, key: str, cols: list[str], run_ts: Column) -> DataFrame:
    """A row that differs in any checked column (NULL-safe) starts a new version at the run time."""
    return _merge(prev, cur, key, lambda o, n: differs([o[c] for c in cols], [n[c] for c in cols]), lambda n: run_ts)


def first_snapshot(cur: DataFrame, start: Column) -> DataFrame:
    return cur.withColumn("valid_from", start).withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
