"""Cohorts, funnel, KPIs, acquisition cost and engagement durations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.dates import week_first
from ledgerloom.functions.keys import surrogate_md5
from ledgerloom.functions.logic import money
from ledgerloom.operators.aggregate import rollup_on
from ledgerloom.operators.ordered import HotKeys, collapse_islands, first_per_key, neighbours, with_first_last

ALL = "All (aggregated)"


def period_index(value: Column, start: dt.date, interval: str) -> Column:
    """Number of whole weeks or months since ``start`` (for months ``start`` is a first of month)."""
    day = value.cast("date")
    if interval == "week":
        return F.floor(F.date_diff(day, F.lit(start)) / 7).cast("int")
    return ((F.year(day) - start.year) * 12 + F.month(day) - start.month).cast("int")


def period_start(index: Column, start: dt.date, interval: str) -> Column:
    return F.date_add(F.lit(start), index * 7) if interval == "week" else F.add_months(F.lit(start), index)


def cohort_sizes(deals: DataFrame, start: dt.date, interval: str, as_of: dt.date) -> DataFrame:
    """Deals per creation period and size class, every period up to ``as_of``, with a total per period."""
    periods = _periods(start, interval, as_of)
    idx = period_index(F.col("created_at"), start, interval)
    counts = rollup_on(deals.select(idx.alias("cohort_no"), "size_class"), ["cohort_no"], "size_class",
                       [F.count(F.lit(1)).alias("n")], ALL)
    # the classes are rows, so there may be any number of them; the calendar is a sequence beside each
    classes = deals.select("size_class").where("size_class IS NOT NULL").union(deals.sparkSession.range(1).select(F.lit(ALL))).distinct()
    grid = classes.select(F.explode(F.sequence(F.lit(0), F.lit(periods - 1))).alias("cohort_no"), "size_class")
    return grid.join(counts, ["cohort_no", "size_class"], "left").select(
        "cohort_no", "size_class", F.coalesce("n", F.lit(0)).alias("cohort_size"))


def _periods(start: dt.date, interval: str, as_of: dt.date) -> int:
    days = (as_of - start).days
    return days // 7 + 1 if interval == "week" else (as_of.year - start.year) * 12 + as_of.month - start.month + 1


def stage_events(deals: DataFrame, stages: list[str], won: list[str], lost: list[str]) -> DataFrame:
    """Wide stage times to events, with the aggregate stages 'all won', 'all lost' and 'all closed'.

    A deal that was both won and lost counts for whichever came last (a tie is a win), at the first time
    it got there, so won and lost add up to closed. Everything is decided inside the row."""
    def entry(name: str, at: Column) -> Column:
        return F.struct(F.lit(name).alias("stage_name"), at.alias("stage_at"))

    def pick(fn, names: list[str]) -> Column:
        cols = [F.col(f"stage_{n}_at") for n in names]
        return fn(*cols) if len(cols) > 1 else cols[0]
    last_won, last_lost = pick(F.greatest, won), pick(F.greatest, lost)
    is_won = last_won.isNotNull() & (last_lost.isNull() | (last_won >= last_lost))
    won_at = F.when(is_won, pick(F.least, won))
    lost_at = F.when(~is_won & last_lost.isNotNull(), pick(F.least, lost))
    entries = [entry(n, F.col(f"stage_{n}_at")) for n in stages]
    entries += [entry("all won", won_at), entry("all lost", lost_at), entry("all closed", F.coalesce(won_at, lost_at))]
    out = deals.select("id", "created_at", "size_class", F.explode(F.array(*entries)).alias("e"))
    return out.select("id", "created_at", "size_class", "e.*").where("stage_at IS NOT NULL")


def deal_cohorts(deals: DataFrame, stages: list[str], won: list[str], lost: list[str], start: dt.date, as_of: dt.date,
                 interval: str = "month", max_delta: int = 0) -> DataFrame:
    """Cohort matrix: creation period x periods since x stage x size class.

    deals(id, created_at, size_class, stage_<name>_at ..). Both period numbers are plain arithmetic, so the
    only joins are with the dense matrix, whose size depends on the calendar and not on the deals."""
    deals = deals.where(F.col("created_at") >= F.lit(start)).withColumn(
        "size_class", F.coalesce("size_class", F.lit("(none)")))
    periods = _periods(start, interval, as_of)
    events = stage_events(deals, stages, won, lost)
    cohort = period_index(F.col("created_at"), start, interval)
    events = events.select(cohort.alias("cohort_no"), (period_index(F.col("stage_at"), start, interval) - cohort)
                           .alias("period_delta"), F.col("stage_name").alias("cohort_type"), "size_class")
    counts = rollup_on(events.where("period_delta >= 0"), ["cohort_no", "period_delta", "cohort_type"], "size_class",
                       [F.count(F.lit(1)).alias("n")], ALL)
    names = F.array(*[F.lit(s) for s in [*stages, "all won", "all lost", "all closed"]])
    last = F.lit(periods - 1) - F.col("cohort_no")
    last = F.least(last, F.lit(max_delta)) if max_delta > 0 else last
    grid = cohort_sizes(deals, start, interval, as_of)
    grid = grid.withColumn("period_delta", F.explode(F.sequence(F.lit(0), last))).withColumn("cohort_type", F.explode(names))
    out = grid.join(counts, ["cohort_no", "period_delta", "cohort_type", "size_class"], "left")
    out = out.withColumn("period_count", F.coalesce("n", F.lit(0)))
    # at most one row per period of the calendar in each partition
    w = Window.partitionBy("cohort_no", "cohort_type", "size_class").orderBy("period_delta").rowsBetween(
        Window.unboundedPreceding, 0)
    out = out.withColumn("cumulative", F.sum("period_count").over(w))
    size = F.nullif(F.col("cohort_size"), F.lit(0))
    out = out.withColumn("period_pct", F.round(F.col("period_count") / size, 4))
    out = out.withColumn("cumulative_pct", F.round(F.col("cumulative") / size, 4))
    out = out.withColumn("cohort_period", period_start(F.col("cohort_no"), start, interval))
    return out.select("cohort_period", "period_delta", "cohort_type", "size_class", "period_count", "cohort_size",
                      "period_pct", "cumulative", "cumulative_pct")


def with_open(cohorts: DataFrame) -> DataFrame:
    """Adds 'all open', the complement of 'all closed', and a key."""
    rest = F.col("cohort_size") - F.col("cumulative")
    pct = 1 - F.col("cumulative_pct")
    opened = cohorts.where("cohort_type = 'all closed'").select(
        "cohort_period", "period_delta", F.lit("all open").alias("cohort_type"), "size_class", rest.alias("period_count"),
        "cohort_size", pct.alias("period_pct"), rest.alias("cumulative"), pct.alias("cumulative_pct"))
    out = cohorts.unionByName(opened)
    return out.withColumn("id", surrogate_md5(*[F.col(c) for c in (
        "cohort_period", "period_delta", "cohort_type", "size_class")]))


def funnel(hist: DataFrame, key: str, state: str, stages: list[str], hot: HotKeys | None,
           order: list[str] | None = None) -> DataFrame:
    """Funnel entries per deal: the last time each stage was entered; stages skipped on the way get the
    deal's first date but no rank.

    After the islands everything is one aggregation per deal: the rank of a stage is the number of stages
    actually entered up to it, so no window is needed."""
    islands = collapse_islands(hist, [key], [state], "valid_from", "valid_to", hot, order)
    at = [F.max(F.when(F.col(state) == s, F.col("valid_from").cast("date"))).alias(f"_s{i}") for i, s in enumerate(stages)]
    wide = islands.where(F.col(state).isin(*stages)).groupBy(key).agg(
        F.min("valid_from").cast("date").alias("_first"), *at)
    reached = F.greatest(*[F.when(F.col(f"_s{i}").isNotNull(), F.lit(i)) for i in range(len(stages))])
    entries, rank = [], F.lit(0)
    for i, s in enumerate(stages):
        own = F.col(f"_s{i}")
        rank = rank + F.when(own.isNotNull(), 1).otherwise(0)
        entries.append(F.struct(
            F.lit(s).alias("stage"), F.coalesce(own, F.when(F.lit(i) <= reached, F.col("_first"))).alias("valid_from"),
            F.lit(i + 1).alias("stage_order"), F.when(own.isNotNull(), rank).alias("date_indicator")))
    out = wide.select(key, F.explode(F.array(*entries)).alias("e")).select(key, "e.*")
    return out.where("valid_from IS NOT NULL")


def stage_kpis(hist: DataFrame, key: str, state: str, value: str, stages: list[str], hot: HotKeys | None,
               order: list[str] | None = None) -> DataFrame:
    """Per week and stage entered: deals, their value and the mean days until the next stage, in long form.
    The value of a deal in a stage is its latest one there."""
    order = order or ["valid_from", "valid_to"]
    hist = with_first_last(hist, [key, state], order, last={"_value": value})
    islands = collapse_islands(hist, [key], [state], "valid_from", "valid_to", hot, order, also=["_value"])
    islands = islands.where(F.col(state).isin(*stages))
    islands = neighbours(islands, [key], ["valid_from", state], hot, following={"_next": "valid_from"})
    days = F.date_diff(F.col("_next").cast("date"), F.col("valid_from").cast("date"))
    week = islands.groupBy(week_first(F.col("valid_from")).alias("week"), state).agg(
        F.count_distinct(key).cast("double").alias("Deals in "),
        F.round(F.sum(money(F.coalesce(F.col("_value"), F.lit(0.0)))).cast("double")).alias("Revenue in "),
        F.round(F.sum(days).cast("double") / F.count(days)).alias("Day duration in "))
    long = week.unpivot(["week", state], ["Deals in ", "Revenue in ", "Day duration in "], "kpi", "kpi_value")
    return long.where("kpi_value IS NOT NULL").select(
        "week", F.replace("kpi", F.lit(" in "), F.lit("")).alias("kpi_category"),
        F.concat("kpi", state).alias("kpi_name"), F.col("kpi_value").cast("bigint").alias("kpi_value"))


def engagement_kpis(events: DataFrame, at: str, ident: str, kind: str, was_won: Column, early: Column) -> DataFrame:
    """Engagements, meetings and calls per week in long form."""
    who = F.col(ident)
    names = {"Engagements by week All - Won": F.when(was_won, who), "Engagements by week All": who,
             "Engagements by week SQL": F.when(early, who), "Meetings per week": F.when(F.col(kind) == "MEETING", who),
             "Calls per week": F.when(F.col(kind) == "CALL", who)}
    week = events.groupBy(week_first(F.col(at)).alias("week")).agg(
        *[F.count_distinct(v).alias(n) for n, v in names.items()])
    week = week.withColumn("Engagements by week MQL", F.col("Engagements by week All") - F.col("Engagements by week SQL"))
    week = week.where(F.col("Engagements by week All") != 0)
    long = week.unpivot(["week"], [*names, "Engagements by week MQL"], "kpi_name", "kpi_value")
    return long.select("week", F.split_part("kpi_name", F.lit(" "), F.lit(1)).alias("kpi_category"), "kpi_name", "kpi_value")


def acquisition_cost(events: DataFrame, won: DataFrame, wages: DataFrame) -> DataFrame:
    """Hours and cost spent on a company before its first win (all of them if it was never won).

    events(company_id, owner_id, at, minutes), won(company_id, won_at), wages(owner_id, paid_at, rate): the
    latest wage counts, owners without one have no cost."""
    first = won.groupBy("company_id").agg(F.min("won_at").alias("won_at"))
    rate = first_per_key(wages, ["owner_id"], [F.col("paid_at").desc_nulls_last()]).select("owner_id", "rate")
    before = events.join(first, "company_id", "left").where(F.col("won_at").isNull() | (F.col("at") < F.col("won_at")))
    sums = before.groupBy("company_id", "owner_id", F.col("won_at").isNotNull().alias("is_acquired")).agg(
        F.count(F.lit(1)).alias("engagements"), (F.sum("minutes").cast("double") / 60).alias("hours"))
    return sums.join(rate, "owner_id", "left").withColumn("cost", F.col("hours") * F.col("rate")).drop("rate")


# Outcome text of a call by its disposition, and the minutes assumed where none were logged.
CALL_OUTCOMES = {"short": "0-5 min", "medium": "5-15 min", "long": "15-30 min", "very_long": ">30 min",
                 "no_answer": "No answer", "wrong_number": "Wrong number", "connected": "COMPLETED"}
ASSUMED_MINUTES = {"0-5 min": 5, "5-15 min": 15, "15-30 min": 30, ">30 min": 60, "COMPLETED": 15}
OVERHEAD_MINUTES = {"MEETING": 30, "CALL": 15}


def engagement_duration(df: DataFrame) -> DataFrame:
    """Outcome, duration class and total minutes of an engagement.

    Input columns: kind, task_status, meeting_outcome, meeting_minutes, call_disposition, call_ms."""
    kind = F.col("kind")
    mail = kind.like("%EMAIL")
    outcome = F.when(kind == "EMAIL", "Outgoing email").when(mail, F.replace(F.upper(kind), F.lit("_"), F.lit(" ")))
    outcome = outcome.when(kind == "TASK", F.col("task_status")).when(kind == "NOTE", "NOTE")
    outcome = outcome.when(kind == "LINKEDIN_MESSAGE", "LinkedIn message")
    outcome = outcome.when(F.col("meeting_outcome").isin("RESCHEDULED", "NO_SHOW"), "TERMINATED").when(kind == "MEETING", "COMPLETED")
    for code, text in CALL_OUTCOMES.items():
        outcome = outcome.when(F.col("call_disposition") == code, text)
    outcome = outcome.when((kind == "CALL") & F.col("call_ms").isNull(), "No answer").when(kind == "CALL", "COMPLETED")
    out = df.withColumn("_pre", outcome)
    pre = F.col("_pre")
    out = out.withColumn("outcome", F.when(pre.isin("0-5 min", "5-15 min", "15-30 min", "COMPLETED", ">30 min"), "COMPLETED")
                         .when(pre.isin("No answer", "Unsuccessful") | pre.like("NOT_STARTED%"), "TERMINATED").otherwise(pre))
    out = out.withColumn("duration", F.round(F.when(kind == "MEETING", F.col("meeting_minutes"))
                                             .when(kind == "CALL", F.col("call_ms") / 1000.0 / 60.0)
                                             .when(mail | (kind == "LINKEDIN_MESSAGE"), F.lit(30.0))))
    o, d = F.col("outcome"), F.col("duration")
    out = out.withColumn(
        "duration_class", F.when(o.isin("TERMINATED", "Wrong number"), "0-5 min")
        .when(d.between(0, 5) | (o == "Outgoing email"), "0-5 min").when(d.between(5, 15), "5-15 min")
        .when(d.between(15, 60) | (o == ">30 min"), "15-60 min").when(d.between(60, 120), "60-120 min").when(d > 120, "> 120 min")
        .when((o == "COMPLETED") | (o == "NOTE"), "Unknown duration").otherwise(o))
    unknown = d.isNull()
    actual = F.when(unknown & o.isin("NOT_STARTED", "FORWARDED_EMAIL", "INCOMING_EMAIL"), 0.0)
    actual = actual.when(o.isin("No answer", "NOTE", "TERMINATED"), 3.0)
    for text, minutes in ASSUMED_MINUTES.items():
        actual = actual.when(unknown & (o == text), float(minutes))
    out = out.withColumn("actual_minutes", actual.otherwise(d))
    total = None
    for name, extra in OVERHEAD_MINUTES.items():
        value = F.col("actual_minutes") + extra
        total = F.when(kind == name, value) if total is None else total.when(kind == name, value)
    out = out.withColumn("total_minutes", F.round(total.otherwise(d)))
    return out.withColumn("kind", F.when(mail, "EMAIL").otherwise(kind)).drop("_pre")
