"""Session settings, table lookup and the shared scratch folder."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every query relies on. Sizes (shuffle partitions, split bytes) stay
# with the cluster: AQE coalesces small partitions and splits skewed ones.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join input even when that costs one more shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def run_once(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is planned and run inside go with the end of its run; else they stay until the driver happens to collect its
    garbage. For rows that are written and read back, since nothing reads those files again."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``; a temporary one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not _is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="ledgerloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared one."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder of ``new_folder``, or one in it, that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    with run_once(df.sparkSession):
        return df.select("*").checkpoint(eager=True)   # a frame that was planned before would keep its shuffle files


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Full parallelism ahead of an explode that multiplies rows. Sized by the session's shuffle partitions:
    left to itself, AQE would merge the still small input into a few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


@dataclass
class Context:
    """What every plan needs: session, input folder, the report date and the business time zone."""

    spark: SparkSession
    root: str
    as_of: dt.date = dt.date(1998, 12, 1)
    tz: str = "Europe/Berlin"
    tables: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        tune(self.spark)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.tables.get(name, f"{self.root}/{name}.parquet"))
