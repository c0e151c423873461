"""Calendar dimension, holidays and time measured in working hours."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.dates import week_first

# Holidays on the same day every year (MMdd).
FIXED_HOLIDAYS = ("0101", "0308", "0501", "1003", "1225", "1226")
# Days from Easter Sunday to Good Friday, Easter Sunday, Easter Monday, Ascension, Whit Monday.
EASTER_OFFSETS = (-2, 0, 1, 39, 50)


def date_dim(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day. Bounded by the calendar (a century is 36,525 rows)."""
    d = F.col("date_key")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias("date_key"))
    return days.select(
        d, F.date_format(d, "yyyyMMdd").alias("date_id"), F.year(d).alias("year"), F.quarter(d).alias("quarter"),
        F.month(d).alias("month"), F.day(d).alias("day"), week_first(d).alias("week_first_day"),
        F.trunc(d, "month").alias("month_first_day"), F.last_day(d).alias("month_last_day"),
        (F.weekday(d) < 5).alias("is_weekday"))


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by the anonymous (Meeus/Jones/Butcher) rule."""
    def idiv(a: Column, b: int) -> Column:
        return F.floor(a / b).cast("int")
    a, b, c = year % 19, idiv(year, 100), year % 100
    h = (19 * a + b - idiv(b, 4) - idiv(b - idiv(b + 8, 25) + 1, 3) + 15) % 30
    rest = (32 + 2 * (b % 4) + 2 * idiv(c, 4) - h - c % 4) % 7
    m = idiv(a + 11 * h + 22 * rest, 451)
    n = h + rest - 7 * m + 114
    return F.make_date(year, idiv(n, 31), n % 31 + 1)


def with_holidays(dim: DataFrame, movable: list[dt.date] | None = None) -> DataFrame:
    """Flag fixed and movable holidays. ``movable`` lists the feasts; without it they follow from Easter."""
    fixed = F.right(F.col("date_id"), F.lit(4)).isin(*FIXED_HOLIDAYS)
    if movable is not None:
        feast = F.col("date_key").isin(*movable)
    else:
        feast = F.date_diff(F.col("date_key"), easter_sunday(F.year("date_key"))).isin(*EASTER_OFFSETS)
    return dim.withColumn("is_holiday", fixed | feast)


def working_minutes(df: DataFrame, start: str, ends: dict[str, Column], opens: Column, closes: Column,
                    cal: DataFrame) -> DataFrame:
    """Service minutes between ``start`` and each of several ends, in local wall time.

    Instead of one row per day, both ends are looked up in a calendar that carries the number of working
    days before each date: minutes(end) - minutes(start). Two joins with a small table, whatever the
    length of the interval. ``opens`` and ``closes`` are hours and may differ per row. A time outside the calendar
    is an error, a NULL time gives 0."""
    before = Window.orderBy("date_key").rowsBetween(Window.unboundedPreceding, -1)   # calendar only
    works = (F.col("is_weekday") & ~F.col("is_holiday")).cast("int")
    days = cal.select("date_key", works.alias("_works"))
    days = days.withColumn("_done", F.coalesce(F.sum("_works").over(before), F.lit(0)))
    span = (closes - opens) * 60

    def total(out: DataFrame, at: Column, name: str) -> DataFrame:
        minute = F.hour(at) * 60 + F.minute(at)
        today = F.greatest(F.lit(0), F.least(span, minute - opens * 60))
        keyed = out.withColumn("_d", at.cast("date")).withColumn("_today", today)
        keyed = keyed.join(days, F.col("_d") == F.col("date_key"), "left")
        value = F.when(F.col("_d").isNotNull() & F.col("date_key").isNull(), F.raise_error(F.concat(F.lit("no calendar day "), F.col("_d").cast("string"))).cast("bigint")
                       ).otherwise(F.col("_done") * span + F.col("_works") * F.col("_today"))
        return keyed.withColumn(name, value).drop("_d", "_today", "date_key", "_works", "_done")

    out = total(df, F.col(start), "_m0")
    for name, end in ends.items():
        out = total(out, end, "_m1").withColumn(name, F.greatest(F.lit(0), F.col("_m1") - F.col("_m0"))).drop("_m1")
    return out.drop("_m0")
