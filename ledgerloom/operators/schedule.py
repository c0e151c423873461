"""Instalment schedules. Dates are built inside the row as arrays: no recursion, no join, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _upper_bound(start: Column, end: Column, k: Column) -> Column:
    """More steps of k months than fit between the two dates."""
    months = F.greatest(F.lit(0), F.ceil(F.months_between(end, start)).cast("int"))
    return F.floor(months / F.greatest(k, F.lit(1))).cast("int") + 2


def chained_dates(start: Column, end: Column, k: Column) -> Column:
    """start, then +k months from the previous date while the next one is before the end.

    Chaining matters from the 29th on: a date clamped to a short month stays at that day."""
    n = _upper_bound(start, end, k)
    steps = F.transform(F.sequence(F.lit(1), n), lambda i: F.add_months(start, (i * k).cast("int")))
    plain = F.concat(F.array(start), F.filter(steps, lambda d: d < end))

    def reached(day: int) -> Column:
        """The first step that falls on this day of the month or an earlier one; after all steps if none does."""
        at = F.array_position(F.transform(steps, lambda d: F.day(d) <= day), True)
        return F.when(at > 0, at).otherwise(n + 1)

    def kept(first: Column) -> Column:
        """Every step on the lowest day reached so far."""
        def moved(d: Column, i: Column) -> Column:
            day = F.when(i + 1 >= first[0], 28).when(i + 1 >= first[1], 29).when(i + 1 >= first[2], 30).otherwise(31)
            return F.date_add(F.trunc(d, "month"), F.least(F.day(d), day) - 1)
        return F.concat(F.array(start), F.filter(F.transform(steps, moved), lambda d: d < end))
    clamped = F.transform(F.array(F.array(*[reached(d) for d in (28, 29, 30)])), kept)[0]
    return F.when(k < 1, F.array(start)).when(F.day(start) <= 28, plain).otherwise(clamped)


def aligned_dates(start: Column, end: Column, k: Column) -> Column:
    """As above, but from the second date on payments fall on the first of a month. The stop rule looks
    at the date before it is moved there, so the last one may touch the end."""
    n = _upper_bound(start, end, k)
    second = F.when(F.day(start) > 1, F.date_add(F.last_day(F.add_months(start, k)), 1)).otherwise(F.add_months(start, k))
    rest = F.filter(F.transform(F.sequence(F.lit(1), n), lambda i: F.add_months(second, (i * k).cast("int"))),
                    lambda d: d < end)
    more = F.add_months(start, k) < end
    return F.when((k < 1) | ~more, F.array(start)).otherwise(F.concat(F.array(start, second), rest))


def within(start: Column, end: Column, years: int) -> Column:
    """The end, or an error where it is more than so many years after the start: an open end is no schedule."""
    late = F.months_between(end, start) > 12 * years
    return F.when(late, F.raise_error(F.concat(F.lit(f"schedule of more than {years} years: "), start.cast("string"), F.lit(" to "), end.cast("string"))).cast("date")).otherwise(end)


def schedule(df: DataFrame, start: str, end: str, k: str, name: str = "due_date", align: str | None = None, years: int = 100) -> DataFrame:
    """One row per instalment; ``years`` is the longest schedule taken."""
    dates = aligned_dates if align == "month_start" else chained_dates
    return df.withColumn(name, F.explode(dates(F.col(start), within(F.col(start), F.col(end), years), F.col(k).cast("int"))))


def outstanding(df: DataFrame, start: str, end: str, k: str, arr: str, one_off: str, as_of: Column, years: int = 100) -> DataFrame:
    """Paid and outstanding instalments and values per contract, computed from the date array in place."""
    dates, months = F.col("_dates"), F.col(k).cast("int")
    amount = F.when(months != 0, F.col(arr) / (F.lit(12.0) / months)).otherwise(F.lit(0.0))
    out = df.withColumn("_dates", chained_dates(F.col(start), within(F.col(start), F.col(end), years), months)).withColumn("amount_per_payment", amount)
    out = out.withColumn("outstanding_installments", F.size(F.filter(dates, lambda d: d > as_of)))
    out = out.withColumn("total_installments", F.size(dates))
    out = out.withColumn("paid_installments", F.col("total_installments") - F.col("outstanding_installments"))
    for part in ("paid", "outstanding"):
        out = out.withColumn(f"{part}_value", F.col(f"{part}_installments") * F.col("amount_per_payment"))
    out = out.withColumn("total_recurring_value", F.col("total_installments") * F.col("amount_per_payment"))
    return out.withColumn("total_contract_value", F.col("total_recurring_value") + F.col(one_off)).drop("_dates")
