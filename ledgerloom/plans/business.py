"""Queries for sales, service, cost, portal and CRM operators (I03, I18-I36, I41-I45)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.context import Context
from ledgerloom.functions.dates import recency, to_local
from ledgerloom.functions.logic import money
from ledgerloom.operators import costs, crm, people, portal, sales
from ledgerloom.operators.calendar import date_dim, with_holidays, working_minutes
from ledgerloom.operators.joins import time_span
from ledgerloom.operators.project import current
from ledgerloom.plans.registry import query
from ledgerloom.plans.shapes import RATE_HIST, STAGE_HIST, hot_entities, rate_hist, stage_hist

c = F.col
STAGES = ["purchase", "signup", "view", "click", "error"]

# ---- I03 cohorts: orders as deals, the first ship date per (flag, status) as stage times

_FLAGS = {"signed": "A' AND l_linestatus = 'O", "running": "A' AND l_linestatus = 'F", "lost": "R' AND l_linestatus = 'O",
          "void": "R' AND l_linestatus = 'F", "cold": "N' AND l_linestatus = 'O", "warm": "N' AND l_linestatus = 'F"}
_WON, _LOST = ["signed", "running"], ["lost", "void"]
_START, _END = dt.date(1995, 1, 1), dt.date(2001, 8, 1)


def _deals(ctx: Context) -> DataFrame:
    lines = ctx.table("lineitem").groupBy("l_orderkey").agg(
        *[F.min(F.when(F.expr(f"l_returnflag = '{flag}'"), c("l_shipdate"))).alias(f"stage_{name}_at") for name, flag in _FLAGS.items()])
    size = F.when(c("o_orderstatus") == "P", F.lit(None)).when(c("o_totalprice") <= 100000, "small").otherwise("large")
    return (ctx.table("orders").join(lines, c("l_orderkey") == c("o_orderkey"), "left")
            .withColumn("size_class", size).withColumnRenamed("o_orderkey", "id").withColumnRenamed("o_orderdate", "created_at")
            .select("id", "created_at", "size_class", *[f"stage_{n}_at" for n in _FLAGS]))


def _cohort_sql(rows: str) -> str:
    stage_cols = ", ".join(f"min(l_shipdate) FILTER (WHERE l_returnflag = '{flag}') AS {n}" for n, flag in _FLAGS.items())
    single = " UNION ALL ".join(f"SELECT id, coh, sz, '{n}' AS stage, {n} AS stage_at FROM w" for n in _FLAGS)
    return f"""
WITH li AS (SELECT l_orderkey, {stage_cols} FROM lineitem GROUP BY l_orderkey),
w AS (SELECT o_orderkey AS id, (year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS coh,
   CASE WHEN o_orderstatus = 'P' THEN '(none)' WHEN o_totalprice <= 100000 THEN 'small' ELSE 'large' END AS sz, li.* EXCLUDE (l_orderkey)
   FROM orders LEFT JOIN li ON l_orderkey = o_orderkey),
o AS (SELECT *, coalesce(greatest(signed, running) >= greatest(lost, void), greatest(signed, running) IS NOT NULL) AND greatest(signed, running) IS NOT NULL AS is_won,
   coalesce(greatest(signed, running), greatest(lost, void)) IS NOT NULL AS is_closed FROM w),
agg AS (SELECT id, coh, sz, CASE WHEN is_won THEN 'all won' ELSE 'all lost' END AS stage, CASE WHEN is_won THEN least(signed, running) ELSE least(lost, void) END AS stage_at
   FROM o WHERE is_closed),
ev AS ({single} UNION ALL SELECT * FROM agg UNION ALL SELECT id, coh, sz, 'all closed', stage_at FROM agg),
evi AS (SELECT coh, sz, stage, (year(stage_at) - 1995) * 12 + month(stage_at) - 1 - coh AS delta FROM ev WHERE stage_at IS NOT NULL),
cnt AS (SELECT coh, delta, stage, CASE WHEN grouping(sz) = 1 THEN 'All (aggregated)' ELSE sz END AS sz, count(*) AS n FROM evi WHERE delta >= 0
   GROUP BY coh, delta, stage, ROLLUP(sz)),
siz AS (SELECT coh, CASE WHEN grouping(sz) = 1 THEN 'All (aggregated)' ELSE sz END AS sz, count(*) AS n FROM w GROUP BY coh, ROLLUP(sz)),
sizes AS (SELECT p.coh, z.sz, coalesce(siz.n, 0) AS cohort_size FROM (SELECT unnest(range(80)) AS coh) p
   CROSS JOIN (SELECT DISTINCT sz FROM w UNION ALL SELECT 'All (aggregated)') z LEFT JOIN siz ON siz.coh = p.coh AND siz.sz = z.sz),
grid AS (SELECT s.*, d.delta, t.stage FROM sizes s JOIN (SELECT unnest(range(80)) AS delta) d ON d.delta <= 79 - s.coh
   CROSS JOIN (SELECT unnest(['{"', '".join([*_FLAGS, "all won", "all lost", "all closed"])}']) AS stage) t),
j AS (SELECT grid.*, coalesce(cnt.n, 0) AS period_count FROM grid LEFT JOIN cnt ON cnt.coh = grid.coh AND cnt.delta = grid.delta AND cnt.stage = grid.stage AND cnt.sz = grid.sz),
cum AS (SELECT *, CAST(sum(period_count) OVER (PARTITION BY coh, stage, sz ORDER BY delta ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative FROM j),
m AS (SELECT CAST(DATE '1995-01-01' + to_months(CAST(coh AS INTEGER)) AS DATE) AS cohort_period, delta AS period_delta, stage AS cohort_type, sz AS size_class, period_count, cohort_size,
   round(CAST(period_count AS DOUBLE) / nullif(cohort_size, 0), 4) AS period_pct, cumulative, round(CAST(cumulative AS DOUBLE) / nullif(cohort_size, 0), 4) AS cumulative_pct FROM cum)
{rows}"""


@query("i03a_cohort_size", _cohort_sql("""SELECT CAST(DATE '1995-01-01' + to_months(CAST(coh AS INTEGER)) AS DATE) AS cohort_period, sz AS size_class, cohort_size FROM sizes"""),
       text="cohort_period")
def i03a(ctx: Context) -> DataFrame:
    deals = _deals(ctx).withColumn("size_class", F.coalesce("size_class", F.lit("(none)")))
    out = sales.cohort_sizes(deals, _START, "month", _END)
    return out.select(sales.period_start(c("cohort_no"), _START, "month").alias("cohort_period"), "size_class", "cohort_size")


@query("i03b_cohort_counts", _cohort_sql("SELECT * FROM m"), text="cohort_period")
def i03b(ctx: Context) -> DataFrame:
    return sales.deal_cohorts(_deals(ctx), list(_FLAGS), _WON, _LOST, _START, _END)


@query("i03c_cohort_open", _cohort_sql("""SELECT cohort_period, period_delta, 'all open' AS cohort_type, size_class, cohort_size - cumulative AS period_count, cohort_size,
  1 - cumulative_pct AS period_pct, cohort_size - cumulative AS cumulative, 1 - cumulative_pct AS cumulative_pct,
  md5(CAST(cohort_period AS VARCHAR) || '-' || period_delta || '-all open-' || size_class) AS id FROM m WHERE cohort_type = 'all closed'"""), text="cohort_period")
def i03c(ctx: Context) -> DataFrame:
    out = sales.with_open(sales.deal_cohorts(_deals(ctx), list(_FLAGS), _WON, _LOST, _START, _END))
    return out.where("cohort_type = 'all open'")


@query("i03d_cohorts_weekly", """
WITH f AS (SELECT user_id, CAST(min(ts) AS DATE) AS created, CAST(min(ts) FILTER (WHERE event_type = 'purchase') AS DATE) AS won,
  CAST(min(ts) FILTER (WHERE event_type = 'error') AS DATE) AS lost FROM events GROUP BY user_id),
x AS (SELECT CAST(floor((created - DATE '2024-01-01') / 7.0) AS BIGINT) AS coh, u.stage, CAST(floor((u.at - DATE '2024-01-01') / 7.0) AS BIGINT) AS wk
  FROM f, LATERAL (SELECT 'won' AS stage, won AS at UNION ALL SELECT 'lost', lost) u WHERE u.at IS NOT NULL),
g AS (SELECT a.coh, d.delta, s.stage FROM (SELECT unnest(range(5)) AS coh) a JOIN (SELECT unnest(range(5)) AS delta) d ON d.delta <= least(2, 4 - a.coh), (VALUES ('won'), ('lost')) s(stage))
SELECT CAST(DATE '2024-01-01' + CAST(g.coh * 7 AS INTEGER) AS DATE) AS cohort_period, g.delta AS period_delta, g.stage AS cohort_type, count(x.coh) AS period_count
FROM g LEFT JOIN x ON x.coh = g.coh AND x.wk - x.coh = g.delta AND x.stage = g.stage GROUP BY ALL""", text="cohort_period")
def i03d(ctx: Context) -> DataFrame:
    """Weekly cohorts of the event users, looking two weeks ahead."""
    deals = ctx.table("events").groupBy(c("user_id").alias("id")).agg(
        F.min("ts").alias("created_at"), F.min(F.when(c("event_type") == "purchase", c("ts"))).alias("stage_won_at"),
        F.min(F.when(c("event_type") == "error", c("ts"))).alias("stage_lost_at")).withColumn("size_class", F.lit("x"))
    out = sales.deal_cohorts(deals, ["won", "lost"], ["won"], ["lost"], dt.date(2024, 1, 1), dt.date(2024, 1, 30), "week", max_delta=2)
    return out.where("size_class = 'x' AND cohort_type IN ('won', 'lost')").select("cohort_period", "period_delta", "cohort_type", "period_count")


_ISLANDS_SQL = """fl AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR stage IS DISTINCT FROM lag(stage) OVER w THEN 1 ELSE 0 END AS chg
  FROM stage_hist WINDOW w AS (PARTITION BY entity_id ORDER BY valid_from, valid_to)),
nu AS (SELECT *, sum(chg) OVER (PARTITION BY entity_id ORDER BY valid_from, valid_to ROWS UNBOUNDED PRECEDING) AS island FROM fl),
isl AS (SELECT entity_id, stage, island, min(valid_from) AS valid_from, max(valid_to) AS valid_to FROM nu GROUP BY ALL)"""


@query("i18_sales_funnel", f"""
WITH {STAGE_HIST}, {_ISLANDS_SQL},
s AS (SELECT entity_id, max(valid_from) FILTER (WHERE stage = 'view') AS s0, max(valid_from) FILTER (WHERE stage = 'click') AS s1, max(valid_from) FILTER (WHERE stage = 'signup') AS s2,
   max(valid_from) FILTER (WHERE stage = 'purchase') AS s3, min(valid_from) AS first_date FROM isl WHERE stage <> 'error' GROUP BY entity_id),
m AS (SELECT *, CASE WHEN s3 IS NOT NULL THEN 3 WHEN s2 IS NOT NULL THEN 2 WHEN s1 IS NOT NULL THEN 1 ELSE 0 END AS reached FROM s),
l AS (SELECT entity_id, 'view' AS stage, s0 AS own, 0 AS ord, first_date, reached FROM m UNION ALL SELECT entity_id, 'click', s1, 1, first_date, reached FROM m
   UNION ALL SELECT entity_id, 'signup', s2, 2, first_date, reached FROM m UNION ALL SELECT entity_id, 'purchase', s3, 3, first_date, reached FROM m)
SELECT entity_id, stage, CAST(coalesce(own, first_date) AS DATE) AS valid_from, ord + 1 AS stage_order,
   CASE WHEN own IS NOT NULL THEN dense_rank() OVER (PARTITION BY entity_id ORDER BY CASE WHEN own IS NOT NULL THEN ord END NULLS LAST) END AS date_indicator
FROM l WHERE ord <= reached""", text="valid_from")
def i18(ctx: Context) -> DataFrame:
    return sales.funnel(stage_hist(ctx), "entity_id", "stage", ["view", "click", "signup", "purchase"], hot_entities(ctx))


@query("i19_kpi_long", f"""
WITH {STAGE_HIST}, v AS (SELECT h.*, last_value(e.value) OVER (PARTITION BY h.entity_id, h.stage ORDER BY h.valid_from, h.valid_to
     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS val FROM stage_hist h JOIN events e USING (event_id)),
fl AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR stage IS DISTINCT FROM lag(stage) OVER w THEN 1 ELSE 0 END AS chg FROM v WINDOW w AS (PARTITION BY entity_id ORDER BY valid_from, valid_to)),
nu AS (SELECT *, sum(chg) OVER (PARTITION BY entity_id ORDER BY valid_from, valid_to ROWS UNBOUNDED PRECEDING) AS island FROM fl),
isl AS (SELECT entity_id, stage, island, val, min(valid_from) AS valid_from FROM nu GROUP BY ALL),
t AS (SELECT *, CAST(date_trunc('week', valid_from) AS DATE) AS week, CAST(lead(valid_from) OVER (PARTITION BY entity_id ORDER BY valid_from) AS DATE) - CAST(valid_from AS DATE) AS days
      FROM isl WHERE stage <> 'error'),
k AS (SELECT week, stage, count(DISTINCT entity_id) AS n, round(CAST(sum(CAST(val AS DECIMAL(18,2))) AS DOUBLE)) AS r, round(CAST(sum(days) AS DOUBLE) / count(days)) AS d FROM t GROUP BY ALL),
e AS (SELECT event_id, CAST(date_trunc('week', ts) AS DATE) AS week, event_type, user_id, value FROM events WHERE event_type NOT IN ('error')),
wk AS (SELECT week, count(DISTINCT event_id) FILTER (WHERE value > 90) AS won, count(DISTINCT event_id) AS al, count(DISTINCT event_id) FILTER (WHERE value < 10) AS sql,
   count(DISTINCT event_id) FILTER (WHERE event_type = 'view') AS mt, count(DISTINCT event_id) FILTER (WHERE event_type = 'click') AS cl FROM e GROUP BY week)
SELECT week, 'Deals' AS kpi_category, 'Deals in ' || stage AS kpi_name, CAST(n AS BIGINT) AS kpi_value FROM k
UNION ALL SELECT week, 'Revenue', 'Revenue in ' || stage, CAST(r AS BIGINT) FROM k
UNION ALL SELECT week, 'Day duration', 'Day duration in ' || stage, CAST(d AS BIGINT) FROM k WHERE d IS NOT NULL
UNION ALL SELECT week, 'Engagements', 'Engagements by week All - Won', won FROM wk UNION ALL SELECT week, 'Engagements', 'Engagements by week All', al FROM wk
UNION ALL SELECT week, 'Engagements', 'Engagements by week SQL', sql FROM wk UNION ALL SELECT week, 'Engagements', 'Engagements by week MQL', al - sql FROM wk
UNION ALL SELECT week, 'Meetings', 'Meetings per week', mt FROM wk UNION ALL SELECT week, 'Calls', 'Calls per week', cl FROM wk""", text="week")
def i19(ctx: Context) -> DataFrame:
    values = ctx.table("events").select("event_id", "value")
    hist = stage_hist(ctx).join(values, "event_id")
    stages = sales.stage_kpis(hist, "entity_id", "stage", "value", STAGES[:4], hot_entities(ctx))
    kind = F.when(c("event_type") == "view", "MEETING").when(c("event_type") == "click", "CALL").otherwise("NOTE")
    events = ctx.table("events").where("event_type <> 'error'").withColumn("kind", kind)
    weekly = sales.engagement_kpis(events, "ts", "event_id", "kind", c("value") > 90, c("value") < 10)
    return stages.unionByName(weekly)


_LOCAL = "timezone('Europe/Berlin', timezone('UTC', {}))"


@query("i20_working_time", f"""
WITH {STAGE_HIST}, h AS (SELECT h.event_id, h.entity_id, {_LOCAL.format('h.valid_from')} AS f, {_LOCAL.format("least(h.valid_to, TIMESTAMP '2024-02-01')")} AS t,
   {_LOCAL.format("least(h.valid_to, TIMESTAMP '2024-02-01', h.valid_from + to_hours(6))")} AS reply, CASE WHEN stage IN ('view', 'click') THEN 8 ELSE 10 END AS o,
   CASE WHEN stage IN ('view', 'click') THEN 17 ELSE 16 END AS cl FROM stage_hist h WHERE stage <> 'error'),
x AS (SELECT *, CAST(unnest(generate_series(CAST(CAST(f AS DATE) AS TIMESTAMP), CAST(CAST(t AS DATE) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM h),
wd AS (SELECT *, CAST(d AS TIMESTAMP) + to_hours(o) AS opens, CAST(d AS TIMESTAMP) + to_hours(cl) AS closes FROM x WHERE isodow(d) < 6 AND d <> DATE '2024-01-01'),
mi AS (SELECT entity_id, greatest(0, date_diff('minute', greatest(f, opens), greatest(greatest(f, opens), least(t, closes)))) AS w,
   greatest(0, date_diff('minute', greatest(f, opens), greatest(greatest(f, opens), least(reply, closes)))) AS r FROM wd)
SELECT entity_id, CAST(sum(w) AS DOUBLE) / 60 AS working_time, CAST(sum(r) AS DOUBLE) / 60 AS time_first_reply FROM mi GROUP BY entity_id""")
def i20(ctx: Context) -> DataFrame:
    """Service hours of tickets in local time: two pipelines with different opening hours."""
    hist = stage_hist(ctx).where("stage <> 'error'")
    until = F.least(c("valid_to"), F.expr("TIMESTAMP_NTZ'2024-02-01 00:00:00'"))
    rows = hist.select("entity_id", "stage", to_local(c("valid_from"), ctx.tz).alias("start"), to_local(until, ctx.tz).alias("until"),
                       to_local(F.least(until, c("valid_from") + F.expr("INTERVAL 6 HOURS")), ctx.tz).alias("reply"))
    fast = c("stage").isin("view", "click")
    cal = with_holidays(date_dim(ctx.spark, *time_span(rows, "start", "until", "reply")))
    out = working_minutes(rows, "start", {"m_work": c("until"), "m_reply": c("reply")}, F.when(fast, 8).otherwise(10),
                          F.when(fast, 17).otherwise(16), cal)
    return out.groupBy("entity_id").agg((F.sum("m_work").cast("double") / 60).alias("working_time"),
                                        (F.sum("m_reply").cast("double") / 60).alias("time_first_reply"))


@query("i21_attendance_hours", """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS a, max(ts) AS b, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id AS employee_id, day, CAST(sum(CASE WHEN hour(b) = 23 THEN 1439 ELSE hour(b) * 60 + minute(b) END - (hour(a) * 60 + minute(a)) - n) AS DOUBLE) / 60 AS working_hours
FROM d GROUP BY ALL""", text="day")
def i21(ctx: Context) -> DataFrame:
    """First to last event of a day as clock times, one minute of break per event; 23h is written as 24:00."""
    day = ctx.table("events").groupBy(c("user_id").alias("employee_id"), F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("a"), F.max("ts").alias("b"), F.count(F.lit(1)).alias("break_minutes"))
    end = F.when(F.hour("b") == 23, "24:00").otherwise(F.date_format("b", "HH:mm"))
    return people.worked_hours(day.select("employee_id", "day", F.date_format("a", "HH:mm").alias("start_time"),
                                          end.alias("end_time"), "break_minutes"))


# Absence kinds by order priority.
_ABSENCE = {"1-URGENT": "paid_vacation", "2-HIGH": "sick_leave", "3-MEDIUM": "offsite_work", "4-NOT SPECIFIED": "parental_leave", "5-LOW": "sick_leave"}
_ABSENCE_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _ABSENCE.items())


@query("i22_absence_days", f"""
WITH a AS (SELECT o_custkey AS emp, CAST(o_orderdate AS DATE) AS f, CAST(o_orderdate + to_days(CAST(o_orderkey % 40 AS INTEGER)) AS DATE) AS t, CASE o_orderpriority {_ABSENCE_SQL} END AS kind,
   o_orderstatus = 'O' AS hs, o_orderstatus = 'F' AS he FROM orders),
x AS (SELECT *, CAST(unnest(generate_series(CAST(f AS TIMESTAMP), CAST(t AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM a),
y AS (SELECT *, CASE WHEN (d = f AND hs) OR (d = t AND he) THEN 0.5 ELSE 1.0 END AS frac FROM x),
ab AS (SELECT emp, d, CAST(sum(frac) FILTER (WHERE kind <> 'offsite_work') AS DOUBLE) AS days, CAST(sum(frac) FILTER (WHERE kind = 'offsite_work') AS DOUBLE) AS remote,
   string_agg(DISTINCT CASE WHEN kind <> 'offsite_work' THEN kind END, ';' ORDER BY CASE WHEN kind <> 'offsite_work' THEN kind END) AS types FROM y GROUP BY emp, d),
wk AS (SELECT o_custkey AS emp, CAST(o_orderdate + to_days(5) AS DATE) AS d, CAST(sum(CAST(o_orderkey % 9 AS DOUBLE)) AS DOUBLE) AS hours FROM orders GROUP BY ALL)
SELECT coalesce(ab.emp, wk.emp) AS employee_id, coalesce(ab.d, wk.d) AS day, hours AS working_hours, CASE WHEN days IS NOT NULL THEN least(days, 1.0::DOUBLE) END AS absence_days,
  CASE WHEN days > 1 AND types LIKE '%sick%' THEN 'sick_leave' ELSE types END AS absence_type,
  CASE WHEN days + remote > 1 THEN nullif(1 - days, 0) ELSE remote END AS homeoffice_days
FROM ab FULL JOIN wk ON ab.emp = wk.emp AND ab.d = wk.d""", text="day")
def i22(ctx: Context) -> DataFrame:
    orders = ctx.table("orders")
    kind = F.coalesce(*[F.when(c("o_orderpriority") == k, F.lit(v)) for k, v in _ABSENCE.items()])
    start = c("o_orderdate").cast("date")
    absences = orders.select(c("o_custkey").alias("employee_id"), kind.alias("kind"), start.alias("start_date"),
                             F.date_add(start, (c("o_orderkey") % 40).cast("int")).alias("end_date"),
                             (c("o_orderstatus") == "O").alias("half_start"), (c("o_orderstatus") == "F").alias("half_end"))
    worked = orders.groupBy(c("o_custkey").alias("employee_id"), F.date_add(start, 5).alias("day")).agg(
        F.sum(c("o_orderkey") % 9).cast("double").alias("working_hours"))
    return people.attendance(worked, people.absence_days(absences))


@query("i23_hourly_rate", f"""
WITH {RATE_HIST}
SELECT owner_id, n AS version, coalesce(round((rate * 150 + rate * 30) / nullif(CASE WHEN owner_id % 5 = 0 THEN 0.0 ELSE 20.0 + n END * 4, 0), 1), 10.0) AS rate_hour, events
FROM rate_hist JOIN (SELECT user_id, count(*) AS events FROM events GROUP BY user_id) e ON e.user_id = owner_id""", num="rate_hour", ints="version")
def i23(ctx: Context) -> DataFrame:
    rows = rate_hist(ctx).withColumn("gross_salary", c("rate") * 150).withColumn("social_security", c("rate") * 30).withColumn(
        "weekly_hours", F.when(c("owner_id") % 5 == 0, 0.0).otherwise(20.0 + c("n")))
    counts = ctx.table("events").groupBy(c("user_id").alias("owner_id")).agg(F.count(F.lit(1)).alias("events"))
    return rows.join(counts, "owner_id").select("owner_id", c("n").alias("version"), people.hourly_rate(rows).alias("rate_hour"), "events")


@query("i24_service_costs", f"""
WITH {RATE_HIST}, w AS (SELECT CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id % 11 END AS company, user_id AS owner, CAST(ts AS DATE) AS day,
    CASE event_type WHEN 'error' THEN 'Ticket' WHEN 'purchase' THEN 'Tech issues' ELSE 'Engagement' END AS cost_type,
    CAST(CASE WHEN event_type IN ('view', 'click', 'signup') THEN CAST(value AS DECIMAL(18,2)) * 0.5 ELSE CAST(value AS DECIMAL(18,2)) END AS DECIMAL(18,3)) AS minutes FROM events)
SELECT coalesce(company, -1) AS company_id, owner AS owner_id, day, cost_type, CAST(sum(minutes) AS DOUBLE) / 60 AS hours_total,
  CAST(sum(minutes * CAST(rate AS DECIMAL(10,2))) AS DOUBLE) / 60 AS cost_total
FROM w JOIN rate_hist r ON r.owner_id = w.owner AND w.day BETWEEN CAST(r.valid_from AS DATE) AND CAST(r.valid_to AS DATE) GROUP BY 1, 2, 3, 4""", text="day")
def i24(ctx: Context) -> DataFrame:
    """Tickets, engagements (shared by two companies, so half the time each) and issues; inclusive rate match."""
    base = ctx.table("events").select(
        F.when(c("event_id") % 7 != 0, c("user_id") % 11).alias("company_id"), c("user_id").alias("owner_id"), c("ts").cast("date").alias("day"),
        "event_type", money(c("value")).cast("decimal(18,3)").alias("minutes"))
    shared = base.where("event_type IN ('view', 'click', 'signup')").withColumn("minutes", (c("minutes") * F.expr("0.5BD")).cast("decimal(18,3)"))
    rates = rate_hist(ctx).withColumn("valid_from", c("valid_from").cast("date")).withColumn("valid_to", c("valid_to").cast("date"))
    kinds = {"Ticket": base.where("event_type = 'error'"), "Tech issues": base.where("event_type = 'purchase'"), "Engagement": shared}
    return people.service_costs({k: v.drop("event_type") for k, v in kinds.items()}, rates, grain="week")


_MONTHLY = "CAST(sum(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"


@query("i25_cost_allocation", f"""
WITH m AS (SELECT c_custkey, n_regionkey AS region, c_acctbal > 0 AS s1, c_nationkey > 10 AS s2, TRUE AS everyone, CAST(greatest(c_acctbal, 0) AS DECIMAL(18,2)) AS sites
   FROM customer JOIN nation ON n_nationkey = c_nationkey),
p AS (SELECT n_regionkey AS region, year(o_orderdate) AS year, {_MONTHLY.format("CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END")} AS pool_s1,
   {_MONTHLY.format("CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END")} AS pool_s2, {_MONTHLY.format("CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE 0 END")} AS pool_misc,
   {_MONTHLY.format('o_totalprice')} AS pool_staff FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL),
t AS (SELECT m.*, p.* EXCLUDE (region), count(*) FILTER (WHERE s1) OVER w AS n1, count(*) FILTER (WHERE s2) OVER w AS n2, count(*) OVER w AS n3,
   CAST(sum(sites) FILTER (WHERE s1) OVER w AS DOUBLE) AS w1, CAST(sum(sites) FILTER (WHERE s2) OVER w AS DOUBLE) AS w2, CAST(sum(sites) OVER w AS DOUBLE) AS w3
   FROM m JOIN p ON p.region = m.region WINDOW w AS (PARTITION BY m.region, p.year))
SELECT c_custkey, region, year, CASE WHEN s1 THEN round(CASE WHEN n1 = 0 THEN 0 ELSE pool_s1 / n1 END * 0.3::DOUBLE + pool_s1 * 0.7::DOUBLE * CASE WHEN w1 = 0 THEN 0 ELSE CAST(sites AS DOUBLE) / w1 END) ELSE 0 END AS allocated_pool_s1,
  CASE WHEN s2 THEN round(CASE WHEN n2 = 0 THEN 0 ELSE pool_s2 / n2 END * 0.3::DOUBLE + pool_s2 * 0.7::DOUBLE * CASE WHEN w2 = 0 THEN 0 ELSE CAST(sites AS DOUBLE) / w2 END) ELSE 0 END AS allocated_pool_s2,
  round(pool_misc / n3 * 0.3::DOUBLE + pool_misc * 0.7::DOUBLE * CASE WHEN w3 = 0 THEN 0 ELSE CAST(sites AS DOUBLE) / w3 END) AS allocated_pool_misc,
  round(pool_staff / n3 * 0.3::DOUBLE + pool_staff * 0.7::DOUBLE * CASE WHEN w3 = 0 THEN 0 ELSE CAST(sites AS DOUBLE) / w3 END) AS allocated_pool_staff FROM t""",
       num="allocated_pool_s1 allocated_pool_s2 allocated_pool_misc allocated_pool_staff", ints="region year")
def i25(ctx: Context) -> DataFrame:
    """Four yearly pools per region over its customers, by balance."""
    nation = ctx.table("nation").select("n_nationkey", c("n_regionkey").alias("region"))
    customers = ctx.table("customer").join(nation, c("n_nationkey") == c("c_nationkey"))
    orders = ctx.table("orders").join(customers.select("c_custkey", "region"), c("c_custkey") == c("o_custkey"))

    def pool(status: str | None) -> Column:
        value = c("o_totalprice") if status is None else F.when(c("o_orderstatus") == status, c("o_totalprice")).otherwise(0.0)
        return F.sum(money(value)).cast("double")
    pools = orders.groupBy("region", F.year("o_orderdate").alias("year")).agg(
        pool("O").alias("pool_s1"), pool("F").alias("pool_s2"), pool("P").alias("pool_misc"), pool(None).alias("pool_staff"))
    years = pools.select("region", "year")
    members = customers.select("c_custkey", "region", (c("c_acctbal") > 0).alias("s1"), (c("c_nationkey") > 10).alias("s2"), F.lit(True).alias("everyone"),
                               money(F.greatest(c("c_acctbal"), F.lit(0.0))).alias("sites")).join(years, "region")
    rules = {"pool_s1": ("s1", "sites"), "pool_s2": ("s2", "sites"), "pool_misc": ("everyone", "sites"), "pool_staff": ("everyone", "sites")}
    return costs.allocate(members, pools, ["region", "year"], rules).select("c_custkey", "region", "year", *["allocated_" + p for p in rules])


@query("i26_usage_allocation", f"""
WITH u AS (SELECT c_nationkey AS nation, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, sum(CAST(l_quantity AS DECIMAL(18,2))) AS seconds, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS storage
   FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
k AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, {_MONTHLY.format("CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END")} AS processing,
   {_MONTHLY.format("CASE WHEN o_orderstatus <> 'O' THEN o_totalprice ELSE 0 END")} AS archive FROM orders GROUP BY 1),
t AS (SELECT u.*, processing, archive, CAST(sum(seconds) OVER (PARTITION BY u.month) AS DOUBLE) AS ts, CAST(sum(storage) OVER (PARTITION BY u.month) AS DOUBLE) AS tg FROM u JOIN k ON k.month = u.month)
SELECT nation, month, processing * (CAST(seconds AS DOUBLE) / ts) AS direct_processing, archive * (CAST(storage AS DOUBLE) / tg) AS direct_archive,
  0.0::DOUBLE + processing * (CAST(seconds AS DOUBLE) / ts) + archive * (CAST(storage AS DOUBLE) / tg) AS direct_total FROM t""", text="month", ints="nation")
def i26(ctx: Context) -> DataFrame:
    orders, month = ctx.table("orders"), lambda x: F.trunc(c(x).cast("date"), "month")
    lines = (ctx.table("lineitem").join(orders.select("o_orderkey", "o_custkey"), c("o_orderkey") == c("l_orderkey"))
             .join(ctx.table("customer").select("c_custkey", "c_nationkey"), c("c_custkey") == c("o_custkey")))
    usage = lines.groupBy(c("c_nationkey").alias("nation"), month("l_shipdate").alias("month")).agg(
        F.sum(money(c("l_quantity"))).alias("seconds"), F.sum(money(c("l_extendedprice"))).alias("storage"))
    is_open = c("o_orderstatus") == "O"
    spent = orders.groupBy(month("o_orderdate").alias("month")).agg(
        F.sum(money(F.when(is_open, c("o_totalprice")).otherwise(0.0))).cast("double").alias("processing"),
        F.sum(money(F.when(~is_open, c("o_totalprice")).otherwise(0.0))).cast("double").alias("archive"))
    out = costs.allocate_by_usage(usage, spent, ["month"], {"processing": ("seconds", "seconds"), "archive": ("storage", "storage")})
    return out.select("nation", "month", "direct_processing", "direct_archive", "direct_total")


@query("i27_customer_margin", """
WITH r AS (SELECT o_custkey AS company_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
   sum(CAST(CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice ELSE 0 END AS DECIMAL(18,2))) AS recurring_revenue, sum(CAST(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice ELSE 0 END AS DECIMAL(18,2))) AS nonrecurring_revenue
   FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL),
d AS (SELECT o_custkey AS company_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, -sum(CAST(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END AS DECIMAL(18,2))) AS direct_staff,
   -sum(CAST(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END AS DECIMAL(18,2))) AS direct_cloud FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL),
i AS (SELECT o_custkey AS company_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, -sum(CAST(CASE WHEN o_totalprice > 250000 THEN o_totalprice ELSE 0 END AS DECIMAL(18,2))) AS indirect_misc
   FROM orders WHERE o_orderstatus = 'P' GROUP BY ALL)
SELECT company_id, month, recurring_revenue, nonrecurring_revenue, direct_staff, direct_cloud, indirect_misc FROM r FULL JOIN d USING (company_id, month) FULL JOIN i USING (company_id, month)
WHERE recurring_revenue > 0 OR nonrecurring_revenue > 0 OR direct_staff < 0 OR direct_cloud < 0 OR indirect_misc < 0""",
       text="month", num="recurring_revenue nonrecurring_revenue direct_staff direct_cloud indirect_misc")
def i27(ctx: Context) -> DataFrame:
    orders, lines = ctx.table("orders"), ctx.table("lineitem")
    month = lambda x: F.trunc(c(x).cast("date"), "month").alias("month")
    who = c("o_custkey").alias("company_id")

    def total(cond: Column, value: str) -> Column:
        return F.sum(money(F.when(cond, c(value)).otherwise(0.0)))
    low = c("o_orderpriority") == "5-LOW"
    revenue = orders.where("o_orderstatus = 'F'").groupBy(who, month("o_orderdate")).agg(
        total(~low, "o_totalprice").alias("recurring_revenue"), total(low, "o_totalprice").alias("nonrecurring_revenue"))
    direct = lines.join(orders.select("o_orderkey", "o_custkey"), c("o_orderkey") == c("l_orderkey")).groupBy(who, month("l_shipdate")).agg(
        (-total(c("l_returnflag") == "R", "l_extendedprice")).alias("direct_staff"), (-total(c("l_returnflag") == "A", "l_quantity")).alias("direct_cloud"))
    indirect = orders.where("o_orderstatus = 'P'").groupBy(who, month("o_orderdate")).agg(
        (-total(c("o_totalprice") > 250000, "o_totalprice")).alias("indirect_misc"))
    return costs.customer_margin(revenue, direct, indirect, ["company_id", "month"], ["recurring_revenue", "nonrecurring_revenue"],
                                 ["direct_staff", "direct_cloud", "indirect_misc"])


@query("i28_acquisition_cost", f"""
WITH {RATE_HIST}, e AS (SELECT user_id AS company, user_id AS owner, ts, event_type, CAST(value AS DECIMAL(18,2)) AS minutes FROM events),
w AS (SELECT company, min(ts) AS won_at FROM e WHERE event_type = 'purchase' AND minutes > 60 GROUP BY company),
r AS (SELECT owner_id, arg_max(rate, valid_from) AS rate FROM rate_hist WHERE owner_id % 10 <> 3 GROUP BY owner_id)
SELECT e.company AS company_id, e.owner AS owner_id, w.won_at IS NOT NULL AS is_acquired, count(*) AS engagements, CAST(sum(minutes) AS DOUBLE) / 60 AS hours,
  CAST(sum(minutes) AS DOUBLE) / 60 * any_value(r.rate) AS cost
FROM e LEFT JOIN w ON w.company = e.company LEFT JOIN r ON r.owner_id = e.owner WHERE w.won_at IS NULL OR e.ts < w.won_at GROUP BY 1, 2, 3""")
def i28(ctx: Context) -> DataFrame:
    events = ctx.table("events").select(c("user_id").alias("company_id"), c("user_id").alias("owner_id"), c("ts").alias("at"), "event_type",
                                        money(c("value")).alias("minutes"))
    won = events.where("event_type = 'purchase' AND minutes > 60").select("company_id", c("at").alias("won_at"))
    wages = rate_hist(ctx).where("owner_id % 10 <> 3").select("owner_id", c("valid_from").alias("paid_at"), "rate")
    return sales.acquisition_cost(events.drop("event_type"), won, wages)


@query("i29_engagement_duration", """
WITH e AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'MEETING' WHEN 'click' THEN 'CALL' WHEN 'signup' THEN CASE WHEN value > 50 THEN 'INCOMING_EMAIL' ELSE 'EMAIL' END WHEN 'error' THEN 'TASK' ELSE 'NOTE' END AS kind,
   CASE WHEN value > 30 THEN 'COMPLETED' ELSE 'NOT_STARTED' END AS task_status, CASE WHEN event_type = 'view' AND value < 5 THEN 'NO_SHOW' END AS meeting_outcome, floor(value * 2) AS mm,
   CASE WHEN event_type = 'click' THEN CASE WHEN value < 10 THEN 'short' WHEN value < 20 THEN 'medium' WHEN value < 30 THEN 'very_long' WHEN value < 35 THEN 'wrong_number' END END AS disp,
   CASE WHEN value > 20 THEN floor(value) * 30000 END AS ms FROM events),
p AS (SELECT *, CASE WHEN kind = 'EMAIL' THEN 'Outgoing email' WHEN kind = 'INCOMING_EMAIL' THEN 'INCOMING EMAIL' WHEN kind = 'TASK' THEN task_status WHEN kind = 'NOTE' THEN 'NOTE'
   WHEN meeting_outcome = 'NO_SHOW' THEN 'TERMINATED' WHEN kind = 'MEETING' THEN 'COMPLETED' WHEN disp = 'short' THEN '0-5 min' WHEN disp = 'medium' THEN '5-15 min' WHEN disp = 'very_long' THEN '>30 min'
   WHEN disp = 'wrong_number' THEN 'Wrong number' WHEN ms IS NULL THEN 'No answer' ELSE 'COMPLETED' END AS pre FROM e),
o AS (SELECT *, CASE WHEN pre IN ('0-5 min', '5-15 min', '>30 min', 'COMPLETED') THEN 'COMPLETED' WHEN pre = 'No answer' OR pre LIKE 'NOT_STARTED%' THEN 'TERMINATED' ELSE pre END AS outcome,
   round(CASE WHEN kind = 'MEETING' THEN mm WHEN kind = 'CALL' THEN ms / 1000.0::DOUBLE / 60.0::DOUBLE WHEN kind LIKE '%EMAIL' THEN 30.0::DOUBLE END) AS duration FROM p),
d AS (SELECT *, CASE WHEN outcome IN ('TERMINATED', 'Wrong number') THEN '0-5 min' WHEN duration BETWEEN 0 AND 5 OR outcome = 'Outgoing email' THEN '0-5 min' WHEN duration BETWEEN 5 AND 15 THEN '5-15 min'
   WHEN duration BETWEEN 15 AND 60 THEN '15-60 min' WHEN duration BETWEEN 60 AND 120 THEN '60-120 min' WHEN duration > 120 THEN '> 120 min' WHEN outcome IN ('COMPLETED', 'NOTE') THEN 'Unknown duration' ELSE outcome END AS duration_class,
   CASE WHEN outcome IN ('No answer', 'NOTE', 'TERMINATED') THEN 3 WHEN duration IS NULL AND outcome = 'COMPLETED' THEN 15 ELSE duration END AS actual_minutes FROM o)
SELECT event_id, CASE WHEN kind LIKE '%EMAIL' THEN 'EMAIL' ELSE kind END AS kind, outcome, duration_class, actual_minutes,
  round(CASE WHEN kind = 'MEETING' THEN actual_minutes + 30 WHEN kind = 'CALL' THEN actual_minutes + 15 ELSE duration END) AS total_minutes FROM d""", num="actual_minutes total_minutes")
def i29(ctx: Context) -> DataFrame:
    v, kind = c("value"), c("event_type")
    e = ctx.table("events").select(
        "event_id", F.when(kind == "view", "MEETING").when(kind == "click", "CALL").when(kind == "signup", F.when(v > 50, "INCOMING_EMAIL").otherwise("EMAIL"))
        .when(kind == "error", "TASK").otherwise("NOTE").alias("kind"), F.when(v > 30, "COMPLETED").otherwise("NOT_STARTED").alias("task_status"),
        F.when((kind == "view") & (v < 5), "NO_SHOW").alias("meeting_outcome"), F.floor(v * 2).cast("double").alias("meeting_minutes"),
        F.when(kind == "click", F.when(v < 10, "short").when(v < 20, "medium").when(v < 30, "very_long").when(v < 35, "wrong_number")).alias("call_disposition"),
        F.when(v > 20, F.floor(v) * 30000).cast("double").alias("call_ms"))
    return sales.engagement_duration(e).select("event_id", "kind", "outcome", "duration_class", "actual_minutes", "total_minutes")


@query("i30_association_bridge", """
WITH b AS (SELECT o_orderkey AS ticket_id, 'company' AS object_type, unnest([o_custkey, o_custkey + 1]) AS object_id FROM orders WHERE o_orderstatus <> 'P'
   UNION ALL SELECT o_orderkey, 'deal', o_orderkey % 100 FROM orders),
p AS (SELECT l_orderkey AS event_id, l_partkey % 200 AS deal_id, nullif(l_suppkey % 3, 2) AS company_id FROM lineitem),
dc AS (SELECT DISTINCT p_partkey % 200 AS deal_id, p_size % 2 AS own FROM part),
k AS (SELECT p.event_id, p.deal_id, coalesce(p.company_id, dc.own) AS company_id FROM p LEFT JOIN dc ON dc.deal_id = p.deal_id
   WHERE p.company_id = dc.own OR dc.own IS NULL OR p.company_id IS NULL),
n AS (SELECT event_id, count(*) AS pairs, count(DISTINCT deal_id) AS num_deals, count(DISTINCT company_id) AS num_companies FROM k GROUP BY event_id)
SELECT 'bridge' AS part, object_type AS label, ticket_id AS id, object_id AS a, CAST(NULL AS BIGINT) AS b FROM b UNION ALL SELECT 'pairs', NULL, event_id, pairs * 1000 + num_deals, num_companies FROM n""")
def i30(ctx: Context) -> DataFrame:
    """Association bridge of orders, and the pairing of line-item deals with companies."""
    cust = c("o_custkey")
    arrays = ctx.table("orders").select(
        c("o_orderkey").alias("ticket_id"), F.when(c("o_orderstatus") != "P", F.array(cust, cust + 1)).alias("companies"),
        F.array(c("o_orderkey") % 100).alias("deals"))
    b = crm.bridge(arrays, "ticket_id", {"company": "companies", "deal": "deals"}).select(
        F.lit("bridge").alias("part"), c("object_type").alias("label"), c("ticket_id").alias("id"), c("object_id").alias("a"), F.lit(None).cast("bigint").alias("b"))
    pairs = ctx.table("lineitem").select(c("l_orderkey").alias("event_id"), (c("l_partkey") % 200).alias("deal_id"),
                                         F.nullif(c("l_suppkey") % 3, F.lit(2)).alias("company_id"))
    own = ctx.table("part").select((c("p_partkey") % 200).alias("deal_id"), (c("p_size") % 2).cast("bigint").alias("company_id"))
    kept = crm.pair_companies(pairs, own).groupBy("event_id").agg(
        F.count(F.lit(1)).alias("pairs"), F.max("num_deals").alias("num_deals"), F.max("num_companies").alias("num_companies"))
    p = kept.select(F.lit("pairs").alias("part"), F.lit(None).cast("string").alias("label"), c("event_id").alias("id"),
                    (c("pairs") * 1000 + c("num_deals")).alias("a"), c("num_companies").alias("b"))
    return b.unionByName(p)


@query("i31_multi_company_check", """
WITH l AS (SELECT DISTINCT l_partkey AS deal_id, l_suppkey AS company_id FROM lineitem), n AS (SELECT *, count(*) OVER (PARTITION BY deal_id) AS parents FROM l)
SELECT deal_id, company_id, parents FROM n WHERE parents > 1 ORDER BY parents DESC, deal_id""")
def i31(ctx: Context) -> DataFrame:
    links = ctx.table("lineitem").select(c("l_partkey").alias("deal_id"), c("l_suppkey").alias("company_id")).distinct()
    return crm.multi_parent(links, "deal_id", "company_id").orderBy(c("parents").desc(), c("deal_id"))


@query("i32_feature_requests", """
WITH l AS (SELECT p_partkey, 'Must-have' AS need_type, w AS v FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part)
   UNION ALL SELECT p_partkey, 'Nice-to-have', w FROM (SELECT p_partkey, unnest(string_split(lower(p_type) || ' ' || split_part(p_name, ' ', 1), ' ')) AS w FROM part WHERE p_size > 10)),
f AS (SELECT p_partkey, need_type, CASE v WHEN 'red' THEN 'Colour - deep red' WHEN 'blue' THEN 'Colour - other' WHEN 'bolt' THEN 'Shape - bolt' ELSE v END AS feature FROM l)
SELECT p_partkey, need_type, feature, split_part(feature, ' - ', 1) AS feature_group, trim(substring(feature, length(split_part(feature, ' - ', 1)) + 4)) AS feature_name,
  CASE WHEN lower(feature) LIKE '% - other' THEN 'other' ELSE 'standard' END AS description_type FROM f""")
def i32(ctx: Context) -> DataFrame:
    rows = ctx.table("part").select(
        "p_partkey", F.replace("p_name", F.lit(" "), F.lit(";")).alias("must"),
        F.when(c("p_size") > 10, F.concat_ws(";", F.lower("p_type"), F.split_part("p_name", F.lit(" "), F.lit(1)))).alias("nice"))
    labels = ctx.spark.createDataFrame([("red", "Colour - deep red"), ("blue", "Colour - other"), ("bolt", "Shape - bolt")], "value string, label string")
    return crm.feature_requests(rows, ["p_partkey"], {"Must-have": "must", "Nice-to-have": "nice"}, labels)


@query("i33_ingestion_stats", """
WITH s AS (SELECT event_id % 50 AS source_id, user_id AS site_id, user_id % 20 AS company_id, event_type AS handler, CAST(ts AS DATE) AS day, CAST(value AS DECIMAL(18,2)) AS v FROM events),
f AS (SELECT CASE WHEN company_id % 4 <> 3 THEN company_id + 100 ELSE -1 END AS company_sk, CASE WHEN site_id % 4 <> 0 THEN site_id + 500 ELSE -1 END AS site_sk, handler, day,
   count(DISTINCT source_id) AS sources, CAST(sum(v) AS DOUBLE) / 1000.0::DOUBLE AS seconds, CAST(sum(v) AS DOUBLE) / 1000000.0::DOUBLE AS data_size, count(*) AS entries FROM s GROUP BY 1, 2, 3, 4)
SELECT * FROM f""", text="day", ints="entries")
def i33(ctx: Context) -> DataFrame:
    stats = ctx.table("events").select(
        (c("event_id") % 50).alias("source_id"), c("user_id").alias("site_id"), (c("user_id") % 20).alias("company_id"), c("event_type").alias("handler"),
        c("ts").cast("date").alias("day"), money(c("value")).alias("duration_ms"), money(c("value")).alias("size"), F.lit(1).alias("entries"))
    companies = stats.select("company_id").distinct().where("company_id % 4 <> 3").withColumn("company_sk", c("company_id") + 100)
    sites = stats.select("site_id").distinct().where("site_id % 4 <> 0").withColumn("site_sk", c("site_id") + 500)
    return portal.ingestions(stats, companies, sites)


@query("i34_recency_status", """
WITH l AS (SELECT c_custkey, max(o_orderdate) AS seen FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' GROUP BY c_custkey)
SELECT c_custkey, CASE WHEN seen IS NULL THEN 'Registered' WHEN DATE '2001-08-01' - CAST(seen AS DATE) <= 300 THEN 'Active' ELSE 'Historical' END AS status FROM l""")
def i34(ctx: Context) -> DataFrame:
    last = ctx.table("orders").where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.max("o_orderdate").alias("seen"))
    return ctx.table("customer").join(last, c("o_custkey") == c("c_custkey"), "left").select(
        "c_custkey", recency(c("seen"), F.lit("2001-08-01").cast("date"), 300).alias("status"))


@query("i35_portfolio_union", """
WITH u AS (SELECT 'first' AS portal, c_custkey AS site_id, c_name AS site_name, c_custkey % 40 AS company_id, c_nationkey AS country, c_acctbal * 3 AS capacity FROM customer
   UNION ALL SELECT 'second', s_suppkey, s_name, s_suppkey % 70, s_nationkey, s_acctbal FROM supplier UNION ALL SELECT 'third', p_partkey, p_name, NULL, NULL, p_retailprice FROM part)
SELECT portal, site_id, site_name, round(CASE WHEN capacity > 10000 THEN capacity / 1000 ELSE capacity END, 2) AS capacity, CASE WHEN company_id % 7 <> 6 AND company_id <= (SELECT max(c_custkey) FROM customer) THEN company_id + 7 ELSE -1 END AS company_sk,
  coalesce(n_nationkey + 1, -1) AS country_sk, dense_rank() OVER (ORDER BY portal, site_id) AS site_sk FROM u LEFT JOIN nation ON n_nationkey = country""", ints="country_sk")
def i35(ctx: Context) -> DataFrame:
    first = ctx.table("customer").select(c("c_custkey").alias("site_id"), c("c_name").alias("site_name"), (c("c_custkey") % 40).alias("company_id"),
                                         c("c_nationkey").alias("country"), (c("c_acctbal") * 3).alias("capacity"))
    second = ctx.table("supplier").select(c("s_suppkey").alias("site_id"), c("s_name").alias("site_name"), (c("s_suppkey") % 70).alias("company_id"),
                                          c("s_nationkey").alias("country"), c("s_acctbal").alias("capacity"))
    third = ctx.table("part").select(c("p_partkey").alias("site_id"), c("p_name").alias("site_name"), c("p_retailprice").alias("capacity"))
    companies = ctx.table("customer").where("c_custkey % 7 <> 6").select(c("c_custkey").alias("company_id"), (c("c_custkey") + 7).alias("company_sk"))
    countries = ctx.table("nation").select(c("n_nationkey").alias("country"), (c("n_nationkey") + 1).alias("country_sk"))
    out = portal.site_dim({"first": first, "second": second, "third": third}, companies, countries)
    return out.select("portal", "site_id", "site_name", "capacity", "company_sk", "country_sk", "site_sk")


@query("i36_capacity_overage", """
WITH s AS (SELECT c_nationkey AS company_id, CAST(abs(c_acctbal) / 10 AS DECIMAL(18,3)) AS cap, abs(c_acctbal) / 10 AS raw, DATE '1998-09-01' + CAST(c_custkey % 90 AS INTEGER) AS created, c_acctbal > 2000 AS live FROM customer WHERE c_mktsegment <> 'MACHINERY'),
a AS (SELECT company_id, CAST(sum(cap) AS DOUBLE) / 1000 AS total_capacity, CAST(sum(CASE WHEN raw >= 200 THEN cap ELSE 0 END) AS DOUBLE) / 1000 AS actual_capacity, count(*) FILTER (WHERE raw < 200) AS actual_sites,
   count(*) FILTER (WHERE created > DATE '1998-11-01') AS sites_last_month, count(*) FILTER (WHERE created > DATE '1998-11-01' AND live) AS sites_last_month_live,
   CAST(sum(CASE WHEN live THEN cap ELSE 0 END) AS DOUBLE) / 1000 AS live_capacity FROM s GROUP BY company_id),
g AS (SELECT s_nationkey AS company_id, count(*) AS signed_sites, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) / 10000 AS signed_mwp FROM supplier WHERE s_acctbal > 0 GROUP BY s_nationkey),
ch AS (SELECT DISTINCT s_nationkey AS company_id FROM supplier WHERE s_acctbal < 1000)
SELECT n_name AS company_name, total_capacity, coalesce(signed_mwp, 0) AS signed_capacity, actual_capacity, coalesce(signed_sites, 0) AS signed_sites, actual_sites, live_capacity,
  round(greatest(actual_capacity - coalesce(signed_mwp, 0), 0), 3) AS capacity_over, greatest(actual_sites - coalesce(signed_sites, 0), 0) AS sites_over, signed_sites IS NOT NULL AS active_deal,
  sites_last_month, sites_last_month_live, ch.company_id IS NOT NULL AS line_item_change
FROM a LEFT JOIN g ON g.company_id = a.company_id FULL JOIN ch ON ch.company_id = a.company_id LEFT JOIN nation ON n_nationkey = coalesce(a.company_id, ch.company_id)
WHERE lower(n_name) NOT LIKE '%_1%_'""", num="signed_capacity capacity_over")
def i36(ctx: Context) -> DataFrame:
    sites = ctx.table("customer").where("c_mktsegment <> 'MACHINERY'").select(
        c("c_nationkey").alias("company_id"), (F.abs("c_acctbal") / 10).alias("capacity"),
        F.date_add(F.lit("1998-09-01").cast("date"), (c("c_custkey") % 90).cast("int")).alias("created"), (c("c_acctbal") > 2000).alias("is_live"))
    supplier = ctx.table("supplier")
    signed = supplier.where("s_acctbal > 0").groupBy(c("s_nationkey").alias("company_id")).agg(
        F.count(F.lit(1)).alias("signed_sites"), (F.sum(money(c("s_acctbal"))).cast("double") / 10000).alias("signed_mwp"))
    changed = supplier.where("s_acctbal < 1000").select(c("s_nationkey").alias("company_id"))
    names = ctx.table("nation").select(c("n_nationkey").alias("company_id"), c("n_name").alias("company_name"))
    return portal.overage(sites, signed, changed, names, F.lit(ctx.as_of), hidden="%_1%_")


@query("i41_feedback_scores", """
SELECT d.lang AS contact, count(DISTINCT d.source) AS sources, sum(quality) FILTER (WHERE toxic = 0) AS effort_sum, count(quality) FILTER (WHERE toxic = 0) AS effort_count,
  sum(quality) FILTER (WHERE toxic = 1) AS faq_sum, count(quality) FILTER (WHERE toxic = 1) AS faq_count
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.lang""", ints="effort_sum faq_sum")
def i41(ctx: Context) -> DataFrame:
    """Labels as survey answers of the language their document is in."""
    docs = ctx.table("documents").select("doc_id", c("lang").alias("contact"), "source")
    users = docs.groupBy("contact").agg(F.count_distinct("source").alias("sources"))
    answers = ctx.table("labels").join(docs.select("doc_id", "contact"), "doc_id").select(
        "contact", F.when(c("toxic") == 0, "effort").otherwise("faq").alias("survey"), c("quality").alias("result"))
    out = crm.feedback(answers, users, "contact", {"effort": "effort", "faq": "faq"})
    return out.withColumns({n: F.coalesce(n, F.lit(0)) for n in ("effort_count", "faq_count")})


@query("i42_targets_plan", """
WITH t AS (SELECT * FROM (VALUES ('1-URGENT', 90000.0), ('2-HIGH', 80000.0), ('3-MEDIUM', 70000.0)) v(category, daily)),
a AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority AS category, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS actual FROM orders GROUP BY ALL)
SELECT a.month, a.category, CAST(daily AS DOUBLE) * day(last_day(a.month)) AS target, actual, CAST(actual AS DOUBLE) - CAST(daily AS DOUBLE) * day(last_day(a.month)) AS gap FROM a JOIN t USING (category)""",
       text="month", num="actual")
def i42(ctx: Context) -> DataFrame:
    """Daily targets against the orders of each month."""
    targets = ctx.spark.createDataFrame([("1-URGENT", 90000.0), ("2-HIGH", 80000.0), ("3-MEDIUM", 70000.0)], "category string, daily double")
    actual = ctx.table("orders").groupBy(F.trunc(c("o_orderdate").cast("date"), "month").alias("month"), c("o_orderpriority").alias("category")).agg(
        F.sum(money(c("o_totalprice"))).alias("actual"))
    target = c("daily") * F.day(F.last_day("month"))
    return actual.join(targets, "category").select("month", "category", target.alias("target"), "actual", (c("actual").cast("double") - target).alias("gap"))


@query("i43_country_dim", """
WITH a AS (SELECT n_name AS code, n_nationkey AS country_id, 'Country ' || n_nationkey AS name FROM nation WHERE n_regionkey <> 2),
b AS (SELECT DISTINCT 'NATION_' || c_nationkey AS code, 'Shape ' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS shape_name FROM customer WHERE c_nationkey <> 1),
m AS (SELECT coalesce(a.code, b.code) AS code, country_id, name, shape_name FROM a FULL JOIN b ON a.code = b.code)
SELECT code, coalesce(country_id, 1000 + dense_rank() OVER (PARTITION BY country_id IS NULL ORDER BY shape_name)) AS country_id, coalesce(name, shape_name) AS name, shape_name FROM m""", ints="country_id")
def i43(ctx: Context) -> DataFrame:
    codes = ctx.table("nation").where("n_regionkey <> 2").select(c("n_name").alias("code"), c("n_nationkey").cast("bigint").alias("country_id"),
                                                                 F.concat(F.lit("Country "), c("n_nationkey").cast("string")).alias("name"))
    shapes = ctx.table("customer").where("c_nationkey <> 1").select(
        F.concat(F.lit("NATION_"), c("c_nationkey").cast("string")).alias("code"),
        F.concat(F.lit("Shape "), F.lpad(c("c_nationkey").cast("string"), 2, "0")).alias("shape_name")).distinct()
    return portal.country_dim(codes, shapes, "code").select("code", "country_id", "name", "shape_name")


@query("i44_pipeline_dim", """
WITH v AS (SELECT p_brand AS pipeline_id, p_type AS stage_id, max(p_partkey) AS seen FROM part GROUP BY ALL),
s AS (SELECT v.*, p_size AS display_order, p_name AS stage_label FROM v JOIN part ON p_partkey = seen)
SELECT pipeline_id, stage_id, stage_label, display_order, CASE WHEN lower(stage_label) LIKE '%red%' THEN 'Hot' WHEN lower(stage_label) LIKE '%cold%' THEN 'Cold' ELSE 'Other' END AS stage_name,
  display_order > 40 AS is_won, dense_rank() OVER (ORDER BY pipeline_id, display_order) AS stage_sk FROM s""", ints="display_order")
def i44(ctx: Context) -> DataFrame:
    """Brands as pipelines with nested stages (types), seen again with every part; the latest sighting counts."""
    part = ctx.table("part").select(
        c("p_brand").alias("pipeline_id"), c("p_brand").alias("label"), c("p_partkey").alias("seen_at"),
        F.array(F.struct(c("p_type").alias("id"), c("p_name").alias("label"), c("p_size").alias("display_order"),
                         F.when(c("p_size") > 40, 1.0).otherwise(0.2).alias("probability"))).alias("stages"))
    out = crm.pipeline_dim(part, [("%red%", "Hot"), ("%cold%", "Cold")])
    return out.select("pipeline_id", "stage_id", "stage_label", "display_order", "stage_name", "is_won", "stage_sk")


@query("i45_dq_projection", f"""
WITH {STAGE_HIST}
SELECT h.entity_id AS deal_id, h.stage, e.value AS amount, e.props IS NULL OR e.value < 5 AS amount_missing, CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS score
FROM stage_hist h JOIN events e USING (event_id) WHERE year(h.valid_to) = 9999""")
def i45(ctx: Context) -> DataFrame:
    """Current deals with the fields a data-quality board looks at."""
    hist = current(stage_hist(ctx))
    e = ctx.table("events").select("event_id", "value", "props")
    return hist.join(e, "event_id").select(
        c("entity_id").alias("deal_id"), "stage", c("value").alias("amount"), (c("props").isNull() | (c("value") < 5)).alias("amount_missing"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("score"))
