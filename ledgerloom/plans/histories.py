"""Queries over row histories (H) and the joins that need them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.context import Context
from ledgerloom.functions.dates import micros
from ledgerloom.operators import history
from ledgerloom.operators.ordered import collapse_islands
from ledgerloom.plans.registry import query
from ledgerloom.plans.shapes import (RATE_HIST, STAGE_HIST, hot_customers, hot_entities, rate_hist, stage_hist,
                                     stage_versions)

c = F.col


@query("h02_islands", f"""
WITH {STAGE_HIST},
flagged AS (
  SELECT *, CASE WHEN stage IS DISTINCT FROM lag(stage) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS chg
  FROM stage_hist WHERE valid_from <> valid_to WINDOW w AS (PARTITION BY entity_id ORDER BY valid_from, valid_to)),
numbered AS (
  SELECT *, sum(chg) OVER (PARTITION BY entity_id ORDER BY valid_from, valid_to ROWS UNBOUNDED PRECEDING) AS island FROM flagged)
SELECT entity_id, stage, min(valid_from) AS valid_from, max(valid_to) AS valid_to, count(*) AS versions,
       max(valid_to) = TIMESTAMP '9999-12-31 00:00:00' AS is_active
FROM numbered GROUP BY entity_id, stage, island""", text="valid_from valid_to")
def h02_islands(ctx: Context) -> DataFrame:
    """Stage intervals: consecutive versions in the same stage collapse, revisited stages stay apart."""
    hist = stage_hist(ctx).where("valid_from <> valid_to")
    out = collapse_islands(hist, ["entity_id"], ["stage"], "valid_from", "valid_to", hot_entities(ctx), count="versions")
    return out.withColumn("is_active", F.year("valid_to") == 9999)


@query("h01_change_history", """
WITH raw AS (SELECT event_id, user_id AS entity_id, nullif(event_type, 'error') AS stage, ts AS valid_from FROM events),
p AS (SELECT *, lag(stage) OVER (PARTITION BY entity_id ORDER BY valid_from, event_id) AS previous_stage FROM raw)
SELECT entity_id, stage, previous_stage, valid_from,
       lead(valid_from) OVER (PARTITION BY entity_id ORDER BY valid_from, event_id) AS valid_until
FROM p WHERE stage IS DISTINCT FROM previous_stage""", text="valid_from valid_until")
def h01(ctx: Context) -> DataFrame:
    """Change log of the stage, where 'error' events stand for an unknown (NULL) stage."""
    raw = stage_versions(ctx).withColumn("stage", F.nullif(c("stage"), F.lit("error")))
    out = history.change_history(raw, "entity_id", "stage", "valid_from", ["valid_from", "event_id"], hot_entities(ctx))
    return out.select("entity_id", "stage", "previous_stage", "valid_from", "valid_until")


_DAYS_SQL = f"""{STAGE_HIST}, days AS (SELECT event_id, entity_id, stage, CAST(valid_from AS DATE) AS valid_from,
  CAST(valid_to AS DATE) AS valid_to FROM stage_hist)"""


def _days(ctx: Context) -> DataFrame:
    return stage_hist(ctx).withColumn("valid_from", c("valid_from").cast("date")).withColumn(
        "valid_to", c("valid_to").cast("date"))


@query("h03_zero_length", f"WITH {_DAYS_SQL} SELECT * FROM days WHERE valid_from <> valid_to", text="valid_from valid_to")
def h03(ctx: Context) -> DataFrame:
    return history.drop_zero_length(_days(ctx)).select("event_id", "entity_id", "stage", "valid_from", "valid_to")


@query("h04_valid_to_from_next", """
SELECT o_orderkey, o_custkey, o_orderdate AS valid_from,
       coalesce(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), TIMESTAMP '9999-12-31 00:00:00') AS valid_to
FROM orders""", text="valid_from valid_to")
def h04(ctx: Context) -> DataFrame:
    rows = ctx.table("orders").select("o_orderkey", "o_custkey", c("o_orderdate").alias("valid_from"))
    return history.derive_valid_to(rows, "o_custkey", "valid_from", ["valid_from", "o_orderkey"], hot_customers(ctx))


@query("h05_daily_snapshot", f"""
WITH {_DAYS_SQL}, r AS (SELECT *, CASE WHEN year(valid_to) = 9999 THEN DATE '2024-01-31' ELSE CAST(valid_to - 1 AS DATE) END AS last_day FROM days),
m AS (SELECT *, max(last_day) OVER (PARTITION BY entity_id) AS max_day FROM r),
x AS (SELECT *, CAST(unnest(generate_series(CAST(valid_from AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS valid_date
      FROM m WHERE valid_from <= last_day)
SELECT entity_id, stage, event_id, valid_date, valid_date = max_day AS is_current, md5(entity_id || '-' || CAST(valid_date AS VARCHAR)) AS snap_id
FROM x""", text="valid_date")
def h05(ctx: Context) -> DataFrame:
    return history.daily_snapshot(_days(ctx), "entity_id", dt.date(2024, 1, 31))


@query("h06_first_win", f"""
WITH {STAGE_HIST} SELECT entity_id, min(valid_from) FILTER (WHERE stage = 'purchase') AS won_date,
  min(valid_from) FILTER (WHERE stage = 'purchase' AND year(valid_to) = 9999) AS won_date_active
FROM stage_hist GROUP BY entity_id HAVING bool_or(stage = 'purchase' AND year(valid_to) = 9999)""", text="won_date won_date_active")
def h06(ctx: Context) -> DataFrame:
    return history.first_state_time(stage_hist(ctx), "entity_id", "stage", "purchase")


_STAGE_NAMES = ["click", "error", "purchase", "signup", "view"]
_WIDE_SQL = ", ".join(
    f"max(valid_from) FILTER (WHERE stage = '{s}') AS entered_{s}, "
    f"coalesce(sum(epoch_us(valid_to) - epoch_us(valid_from)) FILTER (WHERE stage = '{s}' AND year(valid_to) < 9999 "
    f"AND valid_from < TIMESTAMP '2024-01-10'), 0) AS time_{s}" for s in _STAGE_NAMES)


def _wide_stages(ctx: Context) -> DataFrame:
    """One row per user: last entry of each stage and the time spent there before January 10th."""
    hist = stage_hist(ctx)
    spent = F.when((F.year("valid_to") < 9999) & (c("valid_from") < F.expr("TIMESTAMP_NTZ'2024-01-10'")),
                   micros(c("valid_to")) - micros(c("valid_from")))
    aggs = []
    for s in _STAGE_NAMES:
        aggs.append(F.max(F.when(c("stage") == s, c("valid_from"))).alias("hs_entered_" + s))
        aggs.append(F.sum(F.when(c("stage") == s, spent).otherwise(F.lit(0))).alias("hs_time_" + s))
    return hist.groupBy(c("entity_id").alias("owner_id")).agg(*aggs)


@query("h07_stage_entry_fix", f"""
WITH {STAGE_HIST}, {RATE_HIST}, wide AS (SELECT entity_id, {_WIDE_SQL} FROM stage_hist GROUP BY entity_id),
entries AS ({' UNION ALL '.join(f"SELECT entity_id, '{s}' AS stage, entered_{s} AS entered_at FROM wide WHERE entered_{s} IS NOT NULL AND time_{s} <> 0" for s in _STAGE_NAMES)}),
m AS (SELECT r.owner_id, r.n, r.rate, e.stage, coalesce(e.entered_at, r.valid_from) AS valid_from
      FROM rate_hist r LEFT JOIN entries e ON e.entity_id = r.owner_id
        AND ((e.entered_at >= r.valid_from AND e.entered_at < r.valid_to) OR (e.entered_at <= r.valid_from AND r.n = 0)))
SELECT owner_id, n AS version, rate, stage, valid_from,
       coalesce(lead(valid_from) OVER (PARTITION BY owner_id ORDER BY valid_from, stage), TIMESTAMP '9999-12-31 00:00:00') AS valid_to
FROM m""", text="valid_from valid_to", ints="version")
def h07(ctx: Context) -> DataFrame:
    entries = history.stage_entries(_wide_stages(ctx), "owner_id", "hs_entered_", "hs_time_")
    versions = rate_hist(ctx).withColumn("is_first", c("n") == 0)
    out = history.merge_entries(versions, entries, "owner_id", "is_first")
    return out.select("owner_id", c("n").alias("version"), "rate", "stage", "valid_from", "valid_to")


@query("h08_open_start_patch", f"""
WITH {STAGE_HIST}, f AS (SELECT *, min(valid_from) OVER (PARTITION BY entity_id) AS first_from FROM stage_hist)
SELECT event_id, entity_id, CASE WHEN valid_from = first_from THEN TIMESTAMP '1900-01-01' ELSE valid_from END AS valid_from,
       CASE WHEN year(valid_to) = 9999 THEN TIMESTAMP '2024-03-01' ELSE valid_to END AS valid_to FROM f""", text="valid_from valid_to")
def h08(ctx: Context) -> DataFrame:
    out = history.patch_open_ends(stage_hist(ctx), "entity_id", F.expr("TIMESTAMP_NTZ'1900-01-01 00:00:00'"),
                                  F.expr("TIMESTAMP_NTZ'2024-03-01 00:00:00'"))
    return out.select("event_id", "entity_id", "valid_from", "valid_to")


@query("h09_fixed_last_attr", f"""
WITH {STAGE_HIST}, l AS (SELECT event_id, entity_id, stage, last_value(stage) OVER (PARTITION BY entity_id ORDER BY valid_from, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_stage FROM stage_hist)
SELECT event_id, entity_id, last_stage, CASE WHEN stage = last_stage THEN stage END AS last_stage_only FROM l""")
def h09(ctx: Context) -> DataFrame:
    out = history.stamp_last(stage_versions(ctx), "entity_id", "stage", ["valid_from", "event_id"], "last_stage")
    return out.select("event_id", "entity_id", "last_stage", "last_stage_only")


@query("h10_merge_histories", f"""
WITH {STAGE_HIST}, {RATE_HIST},
a AS (SELECT entity_id AS owner_id, valid_from, stage FROM stage_hist),
b AS (SELECT owner_id, valid_from, rate FROM rate_hist WHERE n > 0),
cuts AS (SELECT owner_id, valid_from, max(stage) AS stage, max(rate) AS rate FROM
  (SELECT owner_id, valid_from, stage, NULL AS rate FROM a UNION ALL SELECT owner_id, valid_from, NULL, rate FROM b) u GROUP BY ALL),
carried AS (SELECT owner_id, valid_from, last_value(stage IGNORE NULLS) OVER w AS stage, last_value(rate IGNORE NULLS) OVER w AS rate
  FROM cuts WINDOW w AS (PARTITION BY owner_id ORDER BY valid_from ROWS UNBOUNDED PRECEDING)),
line AS (SELECT c.owner_id, c.valid_from, c.stage, coalesce(c.rate, f.rate) AS rate,
  coalesce(lead(c.valid_from) OVER (PARTITION BY c.owner_id ORDER BY c.valid_from), TIMESTAMP '9999-12-31 00:00:00') AS valid_to
  FROM carried c LEFT JOIN (SELECT owner_id, arg_min(rate, valid_from) AS rate FROM b GROUP BY owner_id) f USING (owner_id) WHERE c.stage IS NOT NULL),
flagged AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR stage IS DISTINCT FROM lag(stage) OVER w OR rate IS DISTINCT FROM lag(rate) OVER w THEN 1 ELSE 0 END AS chg
  FROM line WINDOW w AS (PARTITION BY owner_id ORDER BY valid_from)),
numbered AS (SELECT *, sum(chg) OVER (PARTITION BY owner_id ORDER BY valid_from ROWS UNBOUNDED PRECEDING) AS island FROM flagged)
SELECT owner_id, stage, rate, min(valid_from) AS valid_from, max(valid_to) AS valid_to FROM numbered GROUP BY owner_id, stage, rate, island""",
       text="valid_from valid_to")
def h10(ctx: Context) -> DataFrame:
    """Stage history and rate history (from its second version on) as one timeline."""
    a = stage_hist(ctx).select(c("entity_id").alias("owner_id"), "valid_from", "stage")
    b = rate_hist(ctx).where("n > 0").select("owner_id", "valid_from", "rate")
    out = history.merge_histories(a, b, "owner_id", ["stage"], ["rate"], hot_entities(ctx, key="owner_id"))
    return out.select("owner_id", "stage", "rate", "valid_from", "valid_to")


@query("h11_stage_progression", f"""
WITH {STAGE_HIST}, names AS (SELECT DISTINCT event_type AS stage, upper(event_type) AS name FROM events WHERE event_type <> 'error')
SELECT h.entity_id, h.stage, min(h.valid_from) AS entered_at, coalesce(any_value(n.name), '(deleted stage)') AS stage_name
FROM stage_hist h LEFT JOIN names n ON n.stage = h.stage GROUP BY h.entity_id, h.stage""", text="entered_at")
def h11(ctx: Context) -> DataFrame:
    known = ctx.table("events").where("event_type <> 'error'").select("event_type").distinct()
    names = known.select("event_type", F.upper("event_type").alias("name"))
    return history.stage_progression(stage_versions(ctx), names, "entity_id", "stage", "valid_from")


_FUNNEL = ["signup_at", "view_at", "click_at", "purchase_at"]
_PIVOT_SQL = """p AS (SELECT user_id, min(ts) AS created_at,
  min(ts) FILTER (WHERE event_type = 'signup' AND value > 40) AS signup_at, min(ts) FILTER (WHERE event_type = 'view' AND value > 40) AS view_at,
  min(ts) FILTER (WHERE event_type = 'click' AND value > 40) AS click_at, min(ts) FILTER (WHERE event_type = 'purchase' AND value > 40) AS purchase_at,
  min(ts) FILTER (WHERE value > 40 AND event_type <> 'error') AS earliest
  FROM events GROUP BY user_id)"""


def _stage_times(ctx: Context) -> DataFrame:
    """First time per user and stage, counting events above a value only, so that stages get skipped."""
    counted = F.when((c("value") > 40) & (c("event_type") != "error"), c("ts"))
    return ctx.table("events").withColumn("at", counted).groupBy("user_id").agg(
        F.min("ts").alias("created_at"), F.min("at").alias("earliest"),
        *[F.min(F.when(c("event_type") == name.removesuffix("_at"), c("at"))).alias(name) for name in _FUNNEL])


def _filled(ctx: Context) -> DataFrame:
    start = F.expr("TIMESTAMP_NTZ'2024-01-01 12:00:00'")
    return history.backfill_stages(_stage_times(ctx), _FUNNEL, "created_at", "earliest", start)


def _backfill_sql(i: int) -> str:
    later = ", ".join(_FUNNEL[i:])
    low = f"least({later})" if i < len(_FUNNEL) - 1 else _FUNNEL[i]
    return (f"CASE WHEN created_at >= TIMESTAMP '2024-01-01 12:00:00' THEN {low} ELSE coalesce(nullif({low}, earliest), "
            f"CASE WHEN {_FUNNEL[i]} = earliest THEN {_FUNNEL[i]} END) END AS {_FUNNEL[i]}")


_FILLED_SQL = f"{_PIVOT_SQL}, f AS (SELECT user_id, {', '.join(_backfill_sql(i) for i in range(len(_FUNNEL)))} FROM p)"


@query("h12_stage_backfill", f"WITH {_FILLED_SQL} SELECT * FROM f", text=" ".join(_FUNNEL))
def h12(ctx: Context) -> DataFrame:
    return _filled(ctx).select("user_id", *_FUNNEL)


@query("h13_stage_durations", f"WITH {_FILLED_SQL} SELECT user_id, " + ", ".join(
    f"(epoch_us({b}) - epoch_us({a})) / 1000000.0::DOUBLE / 86400.0::DOUBLE AS days_{a[:-3]}_to_{b[:-3]}"
    for a, b in zip(_FUNNEL, _FUNNEL[1:])) + " FROM f")
def h13(ctx: Context) -> DataFrame:
    return history.stage_durations(_filled(ctx).select("user_id", *_FUNNEL), _FUNNEL).drop(*_FUNNEL)


@query("h14_owner_activity", f"""
WITH {RATE_HIST}, le AS (SELECT user_id, max(ts) AS last_seen FROM events WHERE event_type = 'purchase' GROUP BY user_id),
here AS (SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-30')
SELECT r.owner_id, r.n AS version, NOT ((year(r.valid_to) = 9999 AND r.owner_id NOT IN (SELECT user_id FROM here))
  OR coalesce(CASE WHEN year(r.valid_to) = 9999 THEN TIMESTAMP '2024-01-31' ELSE r.valid_to END > le.last_seen + to_days(2), FALSE)) AS is_active
FROM rate_hist r LEFT JOIN le ON le.user_id = r.owner_id""", ints="version")
def h14(ctx: Context) -> DataFrame:
    events = ctx.table("events").withColumnRenamed("user_id", "owner_id")
    out = history.activity_flag(rate_hist(ctx), events.where("event_type = 'purchase'"),
                                events.where("ts >= TIMESTAMP_NTZ'2024-01-30'"), "owner_id", "ts", 2,
                                F.expr("TIMESTAMP_NTZ'2024-01-31 00:00:00'"))
    return out.select("owner_id", c("n").alias("version"), "is_active")
