"""Exact distinct counts that add up: bitmaps of dense ids, stored at a fine grain and merged to coarser ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ranks import surrogate_rank


def dense_ids(df: DataFrame, near: list[str], value: str, name: str) -> DataFrame:
    """``df`` with a number for every different (near.., value), from 1 on without gaps. Values that are counted together should be near
    each other - those of one site, say - so that a bitmap holds many of them."""
    return surrogate_rank(df, [*near, value], name)


def distinct_states(df: DataFrame, keys: list[str], ident: str) -> DataFrame:
    """``keys.., bucket, bits``: the ids of each key as bitmaps of 32,768 ids each, which is the state of a distinct count. Built where the
    rows are and or-ed on the way, so a key with any number of rows or ids arrives as a few bitmaps of 4 KB. A null id is not counted."""
    rows = df.where(F.col(ident).isNotNull()).withColumn("bucket", F.bitmap_bucket_number(ident))
    return rows.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position(ident)).alias("bits"))


def merged_states(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of coarser keys, which must be columns of ``states``; states of states are states again."""
    return states.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def trailing_states(states: DataFrame, keys: list[str], day: str, days: int) -> DataFrame:
    """For every day between the key's first day and its last, the state of that day and the ``days`` - 1 before it."""
    span = states.groupBy(*keys).agg(F.max(day).alias("_last"))
    ahead = F.sequence(F.col(day), F.least(F.date_add(F.col(day), days - 1), F.col("_last")))
    reach = states.join(span, keys).select(*keys, F.explode(ahead).alias(day), "bucket", "bits")
    return merged_states(reach, [*keys, day])


def count_states(states: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The distinct count of every key, from states of just these keys."""
    return states.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias(name))
