"""Daily counts of an event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_counts(stream: DataFrame, ts: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """Rows per day and key; rows later than the watermark allows are ignored."""
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return (timed.groupBy(F.window("_ts", "1 day"), *keys).agg(F.count(F.lit(1)).alias("count_queries"))
            .select(F.col("window.start").cast("date").alias("day"), *keys, "count_queries"))


def run_to_folder(counts: DataFrame, target: str, checkpoint: str) -> None:
    """Process what is there, then stop. Each micro-batch overwrites the folder of its own number, so a
    batch replayed after a failure leaves no duplicates."""
    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)
    q = (counts.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def latest_counts(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Update mode repeats a key whenever its count grows: the newest batch holds the count."""
    w = Window.partitionBy("day", *keys).orderBy(F.col("batch").desc())
    return updates.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "batch")
