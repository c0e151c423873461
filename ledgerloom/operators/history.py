"""Operators on row histories: change logs, daily snapshots, stage times, merged timelines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import open_end, timedelta
from ledgerloom.functions.keys import surrogate_md5
from ledgerloom.operators.aggregate import unpivot
from ledgerloom.operators.joins import expand_days, first_version_join
from ledgerloom.operators.ordered import (HotKeys, carry_forward, collapse_islands, hot_keys, neighbours,
                                          with_first_last, with_totals)


def change_history(df: DataFrame, key: str, field: str, at: str, order: list[str], hot: HotKeys | None) -> DataFrame:
    """Change log of one field: old value, new value, and how long the new one lasted.

    Rows without a change are dropped (NULL-safe); a first row only counts when it has a value."""
    out = neighbours(df, [key], order, hot, previous={"previous_" + field: field})
    out = out.where(~F.col(field).eqNullSafe(F.col("previous_" + field)))
    return neighbours(out, [key], order, hot, following={"valid_until": at})


def drop_zero_length(df: DataFrame, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    return df.where(F.col(start) != F.col(end))


def derive_valid_to(df: DataFrame, key: str, start: str, order: list[str], hot: HotKeys | None, name: str = "valid_to",
                    default: Column | None = None) -> DataFrame:
    """End of a version = start of the next one; the last takes ``default`` (the open end if not given)."""
    out = neighbours(df, [key], order, hot, following={"_next": start})
    return out.withColumn(name, F.coalesce(F.col("_next"), open_end() if default is None else default)).drop("_next")


def daily_snapshot(df: DataFrame, key: str, as_of: dt.date, start: str = "valid_from", end: str = "valid_to",
                   ) -> DataFrame:
    """One row per entity and day. The end day is exclusive, open versions last until ``as_of``."""
    still_open = F.col(end).isNull() | (F.year(end) == 9999)
    last = F.when(still_open, F.lit(as_of)).otherwise(F.date_sub(F.col(end).cast("date"), 1))
    out = df.withColumn("_first", F.col(start).cast("date")).withColumn("_last", last)
    out = with_totals(out, [key], F.max("_last").alias("_max"))
    out = expand_days(out, "_first", "_last", "valid_date")
    out = out.withColumn("is_current", F.col("valid_date") == F.col("_max"))
    return out.withColumn("snap_id", surrogate_md5(F.col(key), F.col("valid_date"))).drop(
        "_first", "_last", "_max", start, end)


def first_state_time(df: DataFrame, key: str, state: str, win: str, start: str = "valid_from",
                     end: str = "valid_to") -> DataFrame:
    """For entities whose open version is in the winning state: when they first got there
    (``won_date``) and when the open version itself began (``won_date_active``)."""
    won = df.groupBy(key).agg(
        F.min(F.when(F.col(state) == win, F.col(start))).alias("won_date"),
        F.min(F.when((F.col(state) == win) & (F.year(end) == 9999), F.col(start))).alias("won_date_active"))
    return won.where(F.col("won_date_active").isNotNull())


def stage_entries(wide: DataFrame, key: str, entered_prefix: str, time_prefix: str) -> DataFrame:
    """Wide columns ``<entered_prefix><stage>`` / ``<time_prefix><stage>`` back to stage entries.

    Stages an entity spent no time in were skipped and are dropped."""
    cols = [c for c in wide.columns if c.startswith((entered_prefix, time_prefix))]
    text = wide.select(key, *[F.col(c).cast("string").alias(c) for c in cols])
    long = unpivot(text, [key], cols, "_col", "_value")
    entered = F.col("_col").startswith(entered_prefix)
    stage = F.when(entered, F.substring(F.col("_col"), F.lit(len(entered_prefix) + 1), F.length("_col"))).otherwise(
        F.substring(F.col("_col"), F.lit(len(time_prefix) + 1), F.length("_col")))
    out = long.groupBy(key, stage.alias("stage")).agg(
        F.max(F.when(entered, F.col("_value").cast("timestamp_ntz"))).alias("entered_at"),
        F.max(F.when(~entered, F.col("_value").cast("double"))).alias("time_in"))
    return out.where("time_in <> 0").drop("time_in")


def merge_entries(versions: DataFrame, entries: DataFrame, key: str, first: str, grain: str = "week") -> DataFrame:
    """Stage entries sorted into the attribute versions they fell into; ends re-derived from the next start."""
    matched = first_version_join(entries, versions, key, "entered_at", "valid_from", "valid_to", first, grain=grain,
                                 how="inner")
    hit = matched.select(key, "valid_from").distinct()
    bare = versions.join(hit, [key, "valid_from"], "left_anti")
    out = matched.withColumn("valid_from", F.col("entered_at")).unionByName(bare, allowMissingColumns=True)
    hot = hot_keys(key, versions, entries)
    return derive_valid_to(out.drop("valid_to"), key, "valid_from", ["valid_from", "stage"], hot)


def patch_open_ends(df: DataFrame, key: str, far_past: Column, horizon: Column | None = None,
                    start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """The first version of a key reaches back to the far past; open ends optionally get a horizon."""
    out = with_totals(df, [key], F.min(start).alias("_first"))
    out = out.withColumn(start, F.when(F.col(start) == F.col("_first"), far_past).otherwise(F.col(start)))
    if horizon is not None:
        still_open = F.col(end).isNull() | (F.year(end) == 9999)
        out = out.withColumn(end, F.when(still_open, horizon).otherwise(F.col(end)))
    return out.drop("_first")


def stamp_last(df: DataFrame, key: str, column: str, order: list[str], name: str) -> DataFrame:
    """Latest value of an attribute on every version, plus the attribute kept only where equal to it."""
    out = with_first_last(df, [key], order, last={name: column})
    return out.withColumn(name + "_only", F.when(F.col(column).eqNullSafe(F.col(name)), F.col(column)))


def merge_histories(a: DataFrame, b: DataFrame, key: str, a_state: list[str], b_state: list[str], hot: HotKeys | None,
                    start: str = "valid_from") -> DataFrame:
    """Two histories of the same key on one timeline.

    The timeline is cut wherever either history changes. ``a`` rules: it begins when ``a`` does. ``b`` is
    carried forward, and before its first version it takes that version's values. Equal neighbours merge."""
    def points(df: DataFrame, cols: list[str], name: str) -> DataFrame:
        return df.select(key, start, F.struct(*cols).alias(name))
    both = points(a, a_state, "_a").unionByName(points(b, b_state, "_b"), allowMissingColumns=True)
    cuts = both.groupBy(key, start).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    line = carry_forward(cuts, [key], [start], hot, ["_a", "_b"]).where(F.col("_a").isNotNull())
    first_b = b.groupBy(key).agg(F.min_by(F.struct(*b_state), F.col(start)).alias("_b0"))
    line = line.join(first_b, key, "left").withColumn("_b", F.coalesce("_b", "_b0"))
    line = derive_valid_to(line, key, start, [start], hot)
    flat = line.select(key, start, "valid_to", *[F.col("_a")[c].alias(c) for c in a_state],
                       *[F.col("_b")[c].alias(c) for c in b_state])
    return collapse_islands(flat, [key], [*a_state, *b_state], start, "valid_to", hot)


def stage_progression(hist: DataFrame, stages: DataFrame, key: str, stage: str, start: str,
                      missing: str = "(deleted stage)") -> DataFrame:
    """First entry of every (entity, stage) with the stage's name; ``stages`` is (stage, name)."""
    first = hist.groupBy(key, stage).agg(F.min(start).alias("entered_at"))
    names = stages.select(F.col(stages.columns[0]).alias("_s"), F.col(stages.columns[1]).alias("stage_name"))
    out = first.join(names, F.col(stage) == F.col("_s"), "left").drop("_s")
    return out.withColumn("stage_name", F.coalesce("stage_name", F.lit(missing)))


def backfill_stages(df: DataFrame, ordered: list[str], created: str, earliest: str, hist_start: Column) -> DataFrame:
    """A skipped stage takes the time of the next later stage reached.

    Entities created before recording started keep NULL there, unless the stage is their first
    recorded change."""
    new = {}
    for i, name in enumerate(ordered):
        later = [F.col(c) for c in ordered[i:]]
        lowest = F.least(*later) if len(later) > 1 else later[0]
        own = F.when(F.col(name) == F.col(earliest), F.col(name))
        old = F.coalesce(F.nullif(lowest, F.col(earliest)), own)
        new[name] = F.when(F.col(created) >= hist_start, lowest).otherwise(old)
    return df.withColumns(new)


def stage_durations(df: DataFrame, ordered: list[str], suffix: str = "_at") -> DataFrame:
    """Days between consecutive stage timestamps."""
    def stem(c: str) -> str:
        return c.removesuffix(suffix)
    return df.select("*", *[timedelta(F.col(a), F.col(b), "days").alias(f"days_{stem(a)}_to_{stem(b)}")
                            for a, b in zip(ordered, ordered[1:])])


def activity_flag(versions: DataFrame, events: DataFrame, present: DataFrame, key: str, at: str, days: int,
                  as_of: Column, end: str = "valid_to") -> DataFrame:
    """Version is active unless its entity is gone (open version only) or was last seen more than
    ``days`` before the version ended."""
    last = events.groupBy(key).agg(F.max(at).alias("_last"))
    here = present.select(F.col(key)).distinct().withColumn("_here", F.lit(True))
    still_open = F.col(end).isNull() | (F.year(end) == 9999)
    out = versions.join(last, key, "left").join(here, key, "left")
    until = F.when(still_open, as_of).otherwise(F.col(end))
    gone = still_open & F.col("_here").isNull()
    stale = F.coalesce(until > F.col("_last") + F.make_dt_interval(F.lit(days)), F.lit(False))
    return out.withColumn("is_active", ~(gone | stale)).drop("_last", "_here")
