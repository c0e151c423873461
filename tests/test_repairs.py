"""Loads that died, snapshots whose columns change, times outside a calendar, long schedules, very many hot keys."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import ordered
from ledgerloom.operators.calendar import date_dim, with_holidays, working_minutes
from ledgerloom.operators.schedule import chained_dates, schedule
from ledgerloom.sources.incremental import incremental_append
from ledgerloom.sources.snapshots import first_snapshot, snapshot_timestamp


def test_a_load_that_died_is_repeated_whole(spark, tmp_path):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, d, 5), 1) for d in range(1, 6)], "ts timestamp_ntz, v int").cache()
    target = str(tmp_path / "daily")
    build = lambda df: df.groupBy(F.col("ts").cast("date").alias("day")).agg(F.sum("v").alias("n"))
    assert incremental_append(rows, target, "ts", "day", build).count() == 5
    shutil.rmtree(tmp_path / "daily" / "day=2024-01-03")
    shutil.rmtree(tmp_path / "daily" / "_high_watermark")   # as if the load had died before it was done
    assert incremental_append(rows, target, "ts", "day", build).count() == 5
    assert incremental_append(rows, target, "ts", "day", build).count() == 5


def test_snapshots_keep_columns_of_both_sides(spark):
    at = lambda d: F.lit(f"2024-01-0{d}").cast("timestamp_ntz")
    first = spark.createDataFrame([(1, "a", "x")], "id int, old string, kept string").withColumn("updated", at(1))
    history = first_snapshot(first, F.col("updated"))
    second = spark.createDataFrame([(1, "y", 7)], "id int, kept string, new int").withColumn("updated", at(2))
    got = {(r.old, r.kept, r.new, r.valid_to is None) for r in snapshot_timestamp(history, second, "id", "updated").collect()}
    assert got == {("a", "x", None, False), (None, "y", 7, True)}


def test_snapshots_refuse_a_key_that_occurs_twice(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string").withColumn("updated", F.lit("2024-01-01").cast("timestamp_ntz"))
    history = first_snapshot(rows.limit(1), F.col("updated"))
    with pytest.raises(Exception, match="occurs twice"):
        snapshot_timestamp(history, rows, "id", "updated").collect()


def test_working_time_outside_the_calendar_is_an_error(spark):
    cal = with_holidays(date_dim(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31)))
    rows = spark.createDataFrame([("2024-01-29 09:00", "2024-01-30 12:00"), ("2024-01-29 09:00", None)], "a string, b string").select(
        F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    run = lambda df: [r.m for r in working_minutes(df, "a", {"m": F.col("b")}, F.lit(8), F.lit(17), cal).collect()]
    assert sorted(run(rows)) == [0, 720]
    with pytest.raises(Exception, match="no calendar day"):
        run(rows.withColumn("b", F.lit("2024-02-02 10:00").cast("timestamp_ntz")))


@pytest.mark.parametrize("day", [28, 29, 30, 31])
@pytest.mark.parametrize("k", [1, 2, 5])
def test_instalments_stay_on_the_lowest_day_reached(spark, day, k):
    start, end = dt.date(2019, 8, day), dt.date(2031, 3, 1)
    got = spark.range(1).select(chained_dates(F.lit(start), F.lit(end), F.lit(k)).alias("d")).first()["d"]
    want = [start]
    while True:
        months = want[-1].month - 1 + k
        year, month = want[-1].year + months // 12, months % 12 + 1
        last = (dt.date(year + month // 12, month % 12 + 1, 1) - dt.timedelta(days=1)).day
        nxt = dt.date(year, month, min(want[-1].day, last))
        if nxt >= end:
            break
        want.append(nxt)
    assert got == want


def test_an_open_end_is_no_schedule(spark):
    rows = spark.createDataFrame([(dt.date(2024, 1, 31), dt.date(9999, 12, 31), 1)], "a date, b date, k int")
    with pytest.raises(Exception, match="more than 100 years"):
        schedule(rows, "a", "b", "k").collect()
