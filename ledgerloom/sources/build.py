"""Materialising relations: tables, views, and extracts under a column contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.context import new_folder, run_once


def build_table(df: DataFrame, name: str, path: str | None = None, partition_by: list[str] | None = None) -> DataFrame:
    """Full refresh into a folder (a new one unless ``path`` is given), read back from there."""
    spark = df.sparkSession
    path = path or new_folder(spark, name)
    writer = df.write.mode("overwrite")
    with run_once(spark):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.parquet(path)


def save_table(df: DataFrame, name: str, bucket_by: tuple[int, list[str]] | None = None) -> DataFrame:
    """Full refresh of a catalogue table; bucketing lets later joins on the key skip their shuffle."""
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by:
        writer = writer.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def build_view(df: DataFrame, name: str) -> DataFrame:
    """Lazy relation: planned anew with every query that reads it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def literal_df(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def extract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Columns in the order and types another system relies on. Missing columns are an error, and so
    are NULLs in columns the contract declares as never NULL (raised when the extract runs)."""
    missing = [f.name for f in contract.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"extract lacks {missing}")
    cols = []
    for f in contract.fields:
        col = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            col = F.coalesce(col, F.raise_error(F.lit(f"{f.name} is NULL")).cast(f.dataType))
        cols.append(col.alias(f.name))
    return df.select(*cols)


def latest_batch(df: DataFrame, load_col: str, history: DataFrame | None = None) -> DataFrame:
    """Every load repeats the month to date: keep the rows of each month's last load day, then append
    the closed history."""
    day = F.col(load_col).cast("date")
    last = df.groupBy(F.year(load_col), F.month(load_col)).agg(F.max(day).alias("_last")).select("_last")
    kept = df.join(last, day == F.col("_last"), "left_semi")
    return kept if history is None else kept.unionByName(history, allowMissingColumns=True)


def drop_deleted(hist: DataFrame, present: DataFrame, key: str, present_key: str | None = None) -> DataFrame:
    """History of entities the source still knows."""
    keys = present.select(F.col(present_key or key).alias("_k"))
    return hist.join(keys, F.col(key) == F.col("_k"), "left_semi")
