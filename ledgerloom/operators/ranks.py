"""Dense numbers over a whole table: surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.context import checkpointed


def surrogate_rank(df: DataFrame, order: list[str], name: str, dense: bool = True,
                   parts: int | None = None) -> DataFrame:
    """DENSE_RANK (or ROW_NUMBER) OVER (ORDER BY ...) without moving the table to one task.

    Distinct keys are range partitioned and checkpointed (range borders come from a sample, so they
    must not be drawn again), numbered inside each range, and shifted by the sizes of the ranges before.
    Only one count per range is ever brought together."""
    spark = df.sparkSession
    parts = parts or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = df.select(*order)
    keys = keys.distinct() if dense else keys
    asc: list[Column] = [F.col(c).asc_nulls_last() for c in order]
    ranged = checkpointed(keys.repartitionByRange(parts, *asc).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_range").orderBy(*asc)
    ranked = (ranged.withColumn("_rn", F.row_number().over(inside))
              .join(F.broadcast(shift), "_range")   # one row per range: at most ``parts`` rows
              .select(*[F.col(c).alias("_k_" + c) for c in order],
                      (F.col("_rn") + F.col("_shift")).alias(name)))
    if not dense:
        return ranked.select(*[F.col("_k_" + c).alias(c) for c in order], name)
    same = [F.col(c).eqNullSafe(F.col("_k_" + c)) for c in order]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return df.join(ranked, on, "left").drop(*["_k_" + c for c in order])


def row_number_keys(df: DataFrame, order: list[str], name: str, parts: int | None = None) -> DataFrame:
    """ROW_NUMBER over the whole table; ``order`` must identify a row."""
    return df.join(surrogate_rank(df, order, name, dense=False, parts=parts), order)
