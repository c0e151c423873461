"""Date and time helpers. Nothing here reads the clock; callers pass the report date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: end of an interval that is still open.
OPEN_END_TEXT = "9999-12-31"

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def open_end() -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{OPEN_END_TEXT} 00:00:00'")


def open_end_date() -> Column:
    return F.expr(f"DATE'{OPEN_END_TEXT}'")


def day(value: Column) -> Column:
    return value.cast("date")


def month_first(value: Column) -> Column:
    return F.trunc(value.cast("date"), "month")


def week_first(value: Column) -> Column:
    return F.trunc(value.cast("date"), "week")


def micros(value: Column) -> Column:
    """Microseconds since 1970; zone-less values are read in the session zone, which is UTC."""
    return F.unix_micros(value.cast("timestamp"))


def boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """How many unit boundaries lie between two timestamps (not: how many whole units fit)."""
    size = _UNIT_SECONDS[unit] * 1_000_000
    return F.floor(micros(end) / F.lit(size)) - F.floor(micros(start) / F.lit(size))


def timedelta(start: Column, end: Column, period: str) -> Column:
    """Elapsed time in seconds, minutes, hours or days; the first letter of ``period`` decides."""
    sizes = {"s": 1, "m": 60, "h": 3600, "d": 86400}
    if not period or period[0] not in sizes:
        raise ValueError(f"unknown period {period!r}")
    return (micros(end) - micros(start)) / F.lit(1_000_000.0) / F.lit(float(sizes[period[0]]))


def to_local(value: Column, tz: str) -> Column:
    """UTC wall time to local wall time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), value.cast("timestamp_ntz"))


def clean_date(value: Column, sentinel: str | None = None, floor: str | None = None,
               default: str | None = None) -> Column:
    """Sentinel becomes NULL, early dates are lifted to the floor, NULL takes the default."""
    out = value.cast("date")
    if sentinel:
        out = F.nullif(out, F.lit(sentinel).cast("date"))
    if floor:
        out = F.when(out < F.lit(floor).cast("date"), F.lit(floor).cast("date")).otherwise(out)
    if default:
        out = F.coalesce(out, F.lit(default).cast("date"))
    return out


def clock_minutes(value: Column) -> Column:
    """HH:mm to minute of the day; 24:00 is the last minute of the day."""
    fixed = F.when(value == "24:00", F.lit("23:59")).otherwise(value)
    return (F.split_part(fixed, F.lit(":"), F.lit(1)).cast("int") * 60
            + F.split_part(fixed, F.lit(":"), F.lit(2)).cast("int"))


def recency(last_seen: Column, as_of: Column, days: int = 31) -> Column:
    """Registered (never seen), Active (seen within ``days``) or Historical."""
    return (F.when(last_seen.isNull(), F.lit("Registered"))
            .when(F.date_diff(as_of, last_seen.cast("date")) <= days, F.lit("Active"))
            .otherwise(F.lit("Historical")))
