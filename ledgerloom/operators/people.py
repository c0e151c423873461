"""Working hours, absences and wages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import clock_minutes
from ledgerloom.functions.logic import least_strict
from ledgerloom.operators.joins import expand_days_grouped, interval_join
from ledgerloom.operators.project import union_all


def worked_hours(df: DataFrame) -> DataFrame:
    """Clock times to hours per employee and day; df(employee_id, day, start_time, end_time, break_minutes)."""
    minutes = clock_minutes(F.col("end_time")) - clock_minutes(F.col("start_time")) - F.col("break_minutes")
    return df.groupBy("employee_id", "day").agg((F.sum(minutes) / 60.0).alias("working_hours"))


def absence_days(absences: DataFrame, remote: str = "offsite_work") -> DataFrame:
    """Absence intervals to day fractions; absences(employee_id, kind, start_date, end_date, half_start, half_end).
    Remote work is counted on its own and is no absence."""
    day = F.col("day")
    half = ((day == F.col("start_date")) & F.col("half_start")) | ((day == F.col("end_date")) & F.col("half_end"))
    fraction = F.when(half, F.lit(0.5)).otherwise(F.lit(1.0)).cast("decimal(4,1)")
    is_remote = F.col("kind") == remote
    days = expand_days_grouped(absences, ["employee_id"], "start_date", "end_date")
    days = days.withColumn("absence_type", F.when(~is_remote, F.col("kind"))).withColumn("fraction", fraction)
    kinds = F.array_join(F.array_sort(F.collect_set("absence_type")), ";")   # a handful of kinds
    return days.groupBy("employee_id", "month", "day").agg(
        F.sum(F.when(F.col("absence_type").isNotNull(), F.col("fraction"))).cast("double").alias("absence_days"),
        F.sum(F.when(is_remote, F.col("fraction"))).cast("double").alias("homeoffice_days"),
        F.nullif(kinds, F.lit("")).alias("absence_type")).drop("month")


def attendance(worked: DataFrame, absent: DataFrame) -> DataFrame:
    """Hours and absence of an employee day; more than one whole day of absence counts as one."""
    out = worked.join(absent, ["employee_id", "day"], "full")
    total, remote = F.col("absence_days"), F.col("homeoffice_days")
    rest = F.nullif(1 - total, F.lit(0.0))
    return out.select(
        "employee_id", "day", "working_hours", least_strict(total, F.lit(1.0)).alias("absence_days"),
        F.when((total > 1) & F.col("absence_type").like("%sick%"), "sick_leave").otherwise(F.col("absence_type")).alias("absence_type"),
        F.when(total + remote > 1, rest).otherwise(remote).alias("homeoffice_days"))


def hourly_rate(df: DataFrame, default: float = 10.0, digits: int = 1) -> Column:
    """Monthly cost over four weeks of contract hours; ``default`` where either is unknown."""
    rate = (F.col("gross_salary") + F.col("social_security")) / F.nullif(F.col("weekly_hours") * 4, F.lit(0.0))
    return F.coalesce(F.round(rate, digits), F.lit(default))


def service_costs(kinds: dict[str, DataFrame], rates: DataFrame, closed: str = "both", grain: str = "month") -> DataFrame:
    """Hours and cost per company, owner, day and kind of work.

    Each input has (company_id, owner_id, day, minutes as an exact decimal); rates(owner_id, rate, valid_from,
    valid_to) in days. ``closed='both'`` keeps the inclusive match, which counts a change day twice;
    ``'left'`` does not. All kinds are joined to the rates in one pass."""
    work = union_all([df.withColumn("cost_type", F.lit(name)) for name, df in kinds.items()])
    work = work.where(F.col("minutes").isNotNull() & F.col("owner_id").isNotNull())
    priced = interval_join(work, rates, "owner_id", "day", "valid_from", "valid_to", "inner", closed, grain=grain)
    cost = F.col("minutes") * F.col("rate").cast("decimal(10,2)")
    return priced.groupBy(F.coalesce("company_id", F.lit(-1)).alias("company_id"), "owner_id", "day", "cost_type").agg(
        (F.sum("minutes").cast("double") / 60).alias("hours_total"), (F.sum(cost).cast("double") / 60).alias("cost_total"))
