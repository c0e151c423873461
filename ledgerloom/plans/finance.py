"""Queries for calendars, schedules and revenue (I01, I02, I04-I17, I37-I40)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.context import Context
from ledgerloom.functions.logic import decode, money
from ledgerloom.operators import revenue as rev
from ledgerloom.operators.calendar import date_dim, with_holidays
from ledgerloom.operators.joins import null_aware_anti, time_span
from ledgerloom.operators.ordered import collapse_islands
from ledgerloom.operators.project import lookup_labels, union_all
from ledgerloom.operators.schedule import outstanding, schedule
from ledgerloom.plans.registry import query
from ledgerloom.plans.shapes import CONTRACT, PAYMENT_MONTHS, RATE_HIST, STAGE_HIST, contract, hot_entities, rate_hist, stage_hist

c = F.col
AS_OF = "DATE '1998-12-01'"

_DAYS_SQL = """bounds AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds),
n AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS orders FROM orders GROUP BY 1)"""


def _calendar(ctx: Context) -> DataFrame:
    low, high = time_span(ctx.table("orders"), "o_orderdate")
    return date_dim(ctx.spark, low, high)


def _daily_orders(ctx: Context) -> DataFrame:
    return ctx.table("orders").groupBy(c("o_orderdate").cast("date").alias("date_key")).agg(F.count(F.lit(1)).alias("orders"))


@query("i01_date_dim", f"""
WITH {_DAYS_SQL}
SELECT days.d AS date_key, strftime(days.d, '%Y%m%d') AS date_id, year(days.d) AS year, quarter(days.d) AS quarter, month(days.d) AS month,
  day(days.d) AS day, CAST(date_trunc('week', days.d) AS DATE) AS week_first_day, CAST(date_trunc('month', days.d) AS DATE) AS month_first_day,
  last_day(days.d) AS month_last_day, isodow(days.d) < 6 AS is_weekday, coalesce(n.orders, 0) AS orders
FROM days LEFT JOIN n ON n.d = days.d""", text="date_key week_first_day month_first_day month_last_day", ints="year quarter month day")
def i01(ctx: Context) -> DataFrame:
    """Calendar over the span of the orders, with the orders of each day."""
    return _calendar(ctx).join(_daily_orders(ctx), "date_key", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


# Known Easter Sundays of the years the orders cover, for the SQL side.
_EASTERS = ["1995-04-16", "1996-04-07", "1997-03-30", "1998-04-12", "1999-04-04", "2000-04-23", "2001-04-15"]


@query("i02_holiday_flag", f"""
WITH {_DAYS_SQL}, e AS (SELECT CAST(x AS DATE) AS sunday FROM (VALUES {', '.join(f"('{e}')" for e in _EASTERS)}) v(x)),
feasts AS (SELECT CAST(sunday + CAST(o AS INTEGER) AS DATE) AS d FROM e, (VALUES (-2), (0), (1), (39), (50)) v(o))
SELECT days.d AS date_key, strftime(days.d, '%m%d') IN ('0101', '0308', '0501', '1003', '1225', '1226')
  OR days.d IN (SELECT d FROM feasts) AS is_holiday, coalesce(n.orders, 0) AS orders
FROM days LEFT JOIN n ON n.d = days.d""", text="date_key")
def i02(ctx: Context) -> DataFrame:
    out = with_holidays(_calendar(ctx)).join(_daily_orders(ctx), "date_key", "left")
    return out.select("date_key", "is_holiday", F.coalesce("orders", F.lit(0)).alias("orders"))


def _subs(ctx: Context) -> DataFrame:
    """Contracts as subscriptions; those ending after the report date are still open."""
    end = F.when(c("end_date") <= F.lit(ctx.as_of), c("end_date"))
    return contract(ctx).where(c("start_date") <= F.lit(ctx.as_of)).select(
        "company_id", "start_date", end.alias("end_date"), money(c("arr")).alias("monthly_amount"))


_MRR_SQL = f"""{CONTRACT},
subs AS (SELECT company_id, start_date, CASE WHEN end_date <= {AS_OF} THEN end_date END AS end_date, CAST(arr AS DECIMAL(18,2)) AS amount
         FROM contract WHERE start_date <= {AS_OF}),
span AS (SELECT company_id, min(start_date) AS lo, max(coalesce(end_date, {AS_OF})) AS hi FROM subs GROUP BY company_id),
cd AS (SELECT company_id, hi, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM span),
ev AS (SELECT company_id, start_date AS date, amount FROM subs UNION ALL SELECT company_id, end_date, -amount FROM subs WHERE end_date IS NOT NULL),
dl AS (SELECT company_id, date, sum(amount) AS delta FROM ev GROUP BY ALL),
lv AS (SELECT cd.company_id, cd.date, cd.hi, sum(coalesce(dl.delta, 0)) OVER (PARTITION BY cd.company_id ORDER BY cd.date ROWS UNBOUNDED PRECEDING) AS revenue
       FROM cd LEFT JOIN dl ON dl.company_id = cd.company_id AND dl.date = cd.date),
mrr AS (SELECT *, revenue > 0 AS is_active, min(CASE WHEN revenue > 0 THEN date END) OVER (PARTITION BY company_id) AS first_active,
          max(CASE WHEN revenue > 0 THEN date END) OVER (PARTITION BY company_id) AS last_active FROM lv)"""


@query("i04_recurring_revenue_daily", f"""
WITH {_MRR_SQL}
SELECT company_id, CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS days, count(*) FILTER (WHERE is_active) AS active_days,
  sum(revenue) AS revenue_days, count(*) FILTER (WHERE date = first_active) AS starts, count(*) FILTER (WHERE date = last_active) AS ends
FROM mrr GROUP BY 1, 2""", text="month", num="revenue_days")
def i04(ctx: Context) -> DataFrame:
    """Daily recurring revenue of every company, reported per month."""
    daily = rev.mrr_daily(rev.revenue_levels(_subs(ctx), ctx.as_of))
    return daily.groupBy("company_id", F.trunc("date", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("days"), F.count_if("is_active").alias("active_days"), F.sum("monthly_revenue").alias("revenue_days"),
        F.count_if("is_first_date").alias("starts"), F.count_if("is_last_date").alias("ends"))


@query("i05_churn_rows", f"""
WITH {_MRR_SQL}
SELECT company_id, CAST(date + 1 AS DATE) AS date, 0.0::DOUBLE AS monthly_revenue, FALSE AS is_active, first_active AS first_active_date,
  last_active AS last_active_date FROM mrr WHERE date = last_active AND date < {AS_OF}""", text="date first_active_date last_active_date")
def i05(ctx: Context) -> DataFrame:
    return rev.churn_rows(rev.revenue_levels(_subs(ctx), ctx.as_of), ctx.as_of).select(
        "company_id", "date", "monthly_revenue", "is_active", "first_active_date", "last_active_date")


@query("i06_mrr_change", f"""
WITH {_MRR_SQL},
u AS (SELECT company_id, date, revenue, is_active, date = first_active AS is_first FROM mrr
      UNION ALL SELECT company_id, CAST(date + 1 AS DATE), 0, FALSE, FALSE FROM mrr WHERE date = last_active AND date < {AS_OF} AND date = hi),
p AS (SELECT *, coalesce(lag(revenue) OVER w, 0) AS prev, coalesce(lag(is_active) OVER w, FALSE) AS was FROM u
      WINDOW w AS (PARTITION BY company_id ORDER BY date)),
k AS (SELECT *, revenue - prev AS mrr_change, CASE WHEN is_first THEN 'new' WHEN NOT is_active AND was THEN 'churn' WHEN is_active AND NOT was THEN 'reactivation'
        WHEN revenue > prev THEN 'upgrade' WHEN revenue < prev THEN 'downgrade' ELSE 'none' END AS change_category FROM p)
SELECT company_id, CAST(date_trunc('month', date) AS DATE) AS month, change_category, count(*) AS days, sum(revenue) AS revenue_days, sum(mrr_change) AS mrr_change
FROM k GROUP BY 1, 2, 3""", text="month", num="revenue_days mrr_change")
def i06(ctx: Context) -> DataFrame:
    """Every day of a company and how its revenue changed that day, 'none' included, summed by month and kind of change."""
    out = rev.mrr_changes(rev.revenue_levels(_subs(ctx), ctx.as_of), ctx.as_of)
    return out.groupBy("company_id", F.trunc("date", "month").alias("month"), "change_category").agg(
        F.count(F.lit(1)).alias("days"), F.sum("monthly_revenue").alias("revenue_days"), F.sum("mrr_change").alias("mrr_change"))


@query("i07_subscription_build", """
WITH inv AS (SELECT o_orderkey, o_custkey, o_custkey % 3 AS deal_no, o_orderdate,
    CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 6 WHEN '4-NOT SPECIFIED' THEN 12 ELSE 0 END AS months,
    o_orderkey % 2 AS branch FROM orders),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, branch ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM inv) t WHERE rn = 1),
items AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS net FROM lineitem JOIN part ON p_partkey = l_partkey
          WHERE p_name LIKE 'red %' GROUP BY l_orderkey)
SELECT c_custkey * 2 + branch AS deal_id, c_custkey AS customer_id, o_orderkey AS invoice_id, DATE '1995-01-01' AS contract_start,
  CAST(DATE '1999-01-01' + CAST(c_nationkey AS INTEGER) AS DATE) AS contract_end,
  CASE WHEN months > 0 THEN CAST(net AS DOUBLE) / months END AS monthly_amount
FROM latest JOIN items ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey WHERE c_acctbal >= 0 AND c_mktsegment <> 'BUILDING'""",
       text="contract_start contract_end")
def i07(ctx: Context) -> DataFrame:
    deal = c("o_custkey") * 2 + c("o_orderkey") % 2
    invoices = ctx.table("orders").select(
        c("o_orderkey").alias("invoice_id"), c("o_custkey").alias("customer_id"), deal.alias("deal_id"),
        c("o_orderdate").alias("invoice_date"), decode(c("o_orderpriority"), PAYMENT_MONTHS, 0).alias("months"))
    items = ctx.table("lineitem").join(ctx.table("part").select("p_partkey", "p_name"), c("l_partkey") == c("p_partkey")).select(
        c("l_orderkey").alias("invoice_id"), c("p_name").alias("name"), money(c("l_extendedprice")).alias("net"))
    deals = ctx.table("customer").select(
        F.explode(F.array(c("c_custkey") * 2, c("c_custkey") * 2 + 1)).alias("deal_id"), F.lit("1995-01-01").cast("date").alias("contract_start"),
        F.date_add(F.lit("1999-01-01").cast("date"), c("c_nationkey")).alias("contract_end"),
        (c("c_mktsegment") != "BUILDING").alias("is_current"), (c("c_acctbal") < 0).alias("is_archived"))
    return rev.subscriptions(invoices, items, deals, c("name").like("red %"))


@query("i08_line_item_rollup", """
WITH li AS (SELECT l_orderkey AS deal_id, CASE l_returnflag WHEN 'A' THEN 'volume-based saas' WHEN 'N' THEN 'single-site saas'
      ELSE CASE WHEN l_linestatus = 'O' THEN 'volume-based setup' ELSE 'single-site setup' END END AS category,
    CAST(l_quantity AS DECIMAL(18,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS acv, l_linestatus = 'F' AS recurring FROM lineitem),
j AS (SELECT li.*, o_orderstatus = 'P' AS is_poc FROM li JOIN orders ON o_orderkey = deal_id),
s AS (SELECT deal_id, sum(quantity) FILTER (WHERE category = CASE WHEN is_poc THEN 'volume-based setup' ELSE 'volume-based saas' END) AS volume,
    sum(quantity) FILTER (WHERE category = CASE WHEN is_poc THEN 'single-site setup' ELSE 'single-site saas' END) AS single_sites, sum(acv) AS acv,
    sum(acv) FILTER (WHERE recurring) AS arr, coalesce(sum(acv) FILTER (WHERE NOT recurring), 0) AS one_off FROM j GROUP BY deal_id)
SELECT o_orderkey AS deal_id, CAST(volume AS DOUBLE) / 1000 AS volume_based_mwp, single_sites, coalesce(acv, CAST(o_totalprice AS DECIMAL(18,2))) AS annual_contract_value,
  arr AS annual_recurring_revenue, one_off AS one_off_value FROM orders LEFT JOIN s ON s.deal_id = o_orderkey""",
       num="single_sites annual_contract_value annual_recurring_revenue one_off_value")
def i08(ctx: Context) -> DataFrame:
    setup = F.when(c("l_linestatus") == "O", "volume-based setup").otherwise("single-site setup")
    kind = F.when(c("l_returnflag") == "A", "volume-based saas").when(c("l_returnflag") == "N", "single-site saas").otherwise(setup)
    acv, recurring = money(c("l_extendedprice")), c("l_linestatus") == "F"
    items = ctx.table("lineitem").select(
        c("l_orderkey").alias("deal_id"), kind.alias("category"), money(c("l_quantity")).alias("quantity"), acv.alias("acv"),
        F.when(recurring, acv).alias("arr"), F.when(recurring, acv).alias("mrr"), acv.alias("tcv"), recurring.alias("is_recurring"))
    deals = ctx.table("orders").select(c("o_orderkey").alias("deal_id"), (c("o_orderstatus") == "P").alias("is_poc"),
                                       money(c("o_totalprice")).alias("amount"))
    return rev.deal_values(items, deals, "amount").select("deal_id", "volume_based_mwp", "single_sites", "annual_contract_value",
                                                           "annual_recurring_revenue", "one_off_value")


_ISLANDS_SQL = """fl AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR stage IS DISTINCT FROM lag(stage) OVER w THEN 1 ELSE 0 END AS chg
  FROM stage_hist WINDOW w AS (PARTITION BY entity_id ORDER BY valid_from, valid_to)),
nu AS (SELECT *, sum(chg) OVER (PARTITION BY entity_id ORDER BY valid_from, valid_to ROWS UNBOUNDED PRECEDING) AS island FROM fl),
isl AS (SELECT entity_id, stage, island, min(valid_from) AS valid_from, max(valid_to) AS valid_to, min(event_id) AS first_event FROM nu GROUP BY ALL)"""


@query("i09_contracted_revenue", f"""
WITH {STAGE_HIST}, {RATE_HIST}, {_ISLANDS_SQL},
de AS (SELECT entity_id AS deal_id, strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f') AS deal_stage_sk, TIMESTAMP '2024-01-05' AS contract_start,
    TIMESTAMP '2024-01-28' AS contract_end, valid_from, valid_to FROM isl WHERE stage = 'purchase'),
li AS (SELECT owner_id AS deal_id, owner_id * 10 + CASE WHEN n = 2 THEN 1 ELSE 0 END AS line_item_id, rate AS quantity, TIMESTAMP '2024-01-03' AS billing_start,
    CASE WHEN n < 2 THEN TIMESTAMP '2024-01-26' END AS billing_end, valid_from, valid_to FROM rate_hist),
m AS (SELECT de.deal_id, deal_stage_sk, line_item_id, quantity, billing_start, billing_end, contract_start, contract_end,
    greatest(li.valid_from, de.valid_from) AS f, least(li.valid_to, de.valid_to) AS t FROM li JOIN de ON de.deal_id = li.deal_id
      AND li.valid_from < de.valid_to AND li.valid_to > de.valid_from WHERE de.valid_to > contract_start AND de.valid_from < contract_end),
c AS (SELECT *, CASE WHEN f < billing_start THEN billing_start WHEN f < contract_start THEN contract_start ELSE f END AS vf,
    CASE WHEN t > billing_end THEN billing_end WHEN t > contract_end THEN contract_end ELSE t END AS vt FROM m),
g AS (SELECT deal_id, deal_stage_sk, line_item_id, quantity, min(vf) AS vf, max(vt) AS vt FROM c
      WHERE vt > contract_start AND vf < contract_end AND (billing_start IS NULL OR billing_start < vt)
      GROUP BY deal_id, deal_stage_sk, line_item_id, quantity, billing_start, billing_end),
n AS (SELECT *, coalesce(lead(vf) OVER w, vt) AS valid_to, lag(quantity) OVER w AS lag_quantity FROM g
      WINDOW w AS (PARTITION BY deal_id, line_item_id ORDER BY vf, deal_stage_sk))
SELECT deal_id, line_item_id, quantity, vf AS valid_from, valid_to, lag_quantity, TIMESTAMP '2024-01-20' >= vf AND TIMESTAMP '2024-01-20' < valid_to AS is_active,
  NOT coalesce(quantity = lag_quantity, FALSE) AS is_change FROM n""", text="valid_from valid_to")
def i09(ctx: Context) -> DataFrame:
    """Rate versions as line items under the intervals in which a user was in the won stage."""
    ts = lambda text: F.expr(f"TIMESTAMP_NTZ'{text}'")
    won = collapse_islands(stage_hist(ctx), ["entity_id"], ["stage"], "valid_from", "valid_to", hot_entities(ctx)).where("stage = 'purchase'")
    deals = won.select(c("entity_id").alias("deal_id"), F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("deal_stage_sk"),
                       ts("2024-01-05").alias("contract_start"), ts("2024-01-28").alias("contract_end"),
                       c("valid_from").alias("deal_from"), c("valid_to").alias("deal_to"))
    items = rate_hist(ctx).select(
        c("owner_id").alias("deal_id"), (c("owner_id") * 10 + F.when(c("n") == 2, 1).otherwise(0)).alias("line_item_id"),
        c("rate").alias("quantity"), ts("2024-01-03").alias("billing_start"), F.when(c("n") < 2, ts("2024-01-26")).alias("billing_end"),
        c("valid_from").alias("item_from"), c("valid_to").alias("item_to"))
    low, high = time_span(ctx.table("events"), "ts")
    span = (min(low, dt.date(2024, 1, 1)), max(high, dt.date(2024, 1, 21)))
    out = rev.contracted_revenue(items, deals, ts("2024-01-20"), span, "week")
    return out.select("deal_id", "line_item_id", "quantity", "valid_from", "valid_to", "lag_quantity", "is_active", "is_change")


@query("i10_invoiced_revenue", """
SELECT l_orderkey AS invoice_id, o_orderdate AS invoice_date, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderkey + 5000 END, -1) AS deal_sk,
  coalesce(CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END, CASE WHEN o_orderstatus <> 'P' THEN o_custkey + 1 END, -1) AS company_sk,
  coalesce(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END, CASE WHEN o_orderstatus <> 'P' THEN 12 END, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS payment_interval,
  coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_linestatus = 'F'), 0) AS recurring_amount,
  coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_linestatus <> 'F'), 0) AS non_recurring_amount,
  sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total_amount
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, 3, 4, 5""",
       text="invoice_date", num="recurring_amount non_recurring_amount total_amount", ints="payment_interval")
def i10(ctx: Context) -> DataFrame:
    orders = ctx.table("orders")
    lines = ctx.table("lineitem").join(orders, c("o_orderkey") == c("l_orderkey")).select(
        c("l_orderkey").alias("invoice_id"), c("o_orderkey").alias("deal_id"), c("o_orderdate").alias("invoice_date"),
        F.when(c("o_orderpriority") != "5-LOW", c("o_custkey")).alias("company_id"),
        F.when(c("o_orderpriority") == "1-URGENT", 1).alias("months"), (c("l_linestatus") == "F").alias("is_recurring"),
        money(c("l_extendedprice")).alias("net"))
    deals = orders.where("o_orderstatus <> 'P'").select(
        c("o_orderkey").alias("deal_id"), (c("o_orderkey") + 5000).alias("deal_sk"), (c("o_custkey") + 1).alias("company_id"),
        F.lit(12).alias("months"))
    return rev.invoiced_revenue(lines, deals)


@query("i11_invoiced_vs_booked", """
WITH a AS (SELECT l_orderkey AS k, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS invoice_revenue, sum(CAST(l_discount AS DECIMAL(18,2))) AS total_discount,
    count(*) AS line_items FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_orderkey),
b AS (SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS booked_credit, CAST(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END AS DECIMAL(18,2)) AS booked_debit
      FROM orders WHERE o_orderstatus <> 'O')
SELECT coalesce(a.k, b.k) AS invoice_number, invoice_revenue, total_discount, line_items, booked_credit, booked_debit FROM a FULL JOIN b ON a.k = b.k""",
       num="invoice_revenue total_discount booked_credit booked_debit")
def i11(ctx: Context) -> DataFrame:
    lines = ctx.table("lineitem").where("l_returnflag <> 'R'").select(
        c("l_orderkey").alias("invoice_number"), money(c("l_extendedprice")).alias("net"), money(c("l_discount")).alias("discount"))
    booked = ctx.table("orders").where("o_orderstatus <> 'O'").select(
        c("o_orderkey").alias("invoice_number"), money(c("o_totalprice")).alias("credit"),
        money(F.when(c("o_orderstatus") == "F", c("o_totalprice")).otherwise(0.0)).alias("debit"))
    return rev.reconcile(lines, booked, "invoice_number")


@query("i12_payment_schedule", f"""
WITH RECURSIVE {CONTRACT},
r AS (SELECT deal_id, start_date AS due_date, end_date, k FROM contract
      UNION ALL SELECT deal_id, CAST(due_date + to_months(k) AS DATE), end_date, k FROM r WHERE CAST(due_date + to_months(k) AS DATE) < end_date AND k >= 1)
SELECT deal_id, due_date FROM r""", text="due_date")
def i12(ctx: Context) -> DataFrame:
    return schedule(contract(ctx), "start_date", "end_date", "k").select("deal_id", "due_date")


@query("i13_aligned_schedule", f"""
WITH RECURSIVE {CONTRACT},
r AS (SELECT deal_id, start_date AS due_date, end_date, k FROM contract
      UNION ALL SELECT deal_id, CASE WHEN day(due_date) > 1 THEN CAST(last_day(CAST(due_date + to_months(k) AS DATE)) + 1 AS DATE)
                                     ELSE CAST(due_date + to_months(k) AS DATE) END, end_date, k
      FROM r WHERE CAST(due_date + to_months(k) AS DATE) < end_date AND k >= 1)
SELECT deal_id, due_date FROM r""", text="due_date")
def i13(ctx: Context) -> DataFrame:
    return schedule(contract(ctx), "start_date", "end_date", "k", align="month_start").select("deal_id", "due_date")


@query("i14_outstanding", f"""
WITH RECURSIVE {CONTRACT},
r AS (SELECT deal_id, start_date AS due_date, end_date, k FROM contract WHERE {AS_OF} BETWEEN start_date AND end_date
      UNION ALL SELECT deal_id, CAST(due_date + to_months(k) AS DATE), end_date, k FROM r WHERE CAST(due_date + to_months(k) AS DATE) < end_date AND k >= 1),
n AS (SELECT deal_id, count(*) AS total, count(*) FILTER (WHERE due_date > {AS_OF}) AS outstanding FROM r GROUP BY deal_id),
a AS (SELECT n.*, company_id, k, CASE WHEN k <> 0 THEN arr / (12.0::DOUBLE / k) ELSE 0.0 END AS amount, CASE WHEN k = 0 THEN arr ELSE 0.0 END AS one_off
      FROM n JOIN contract USING (deal_id))
SELECT deal_id, company_id, amount AS amount_per_payment, total - outstanding AS paid_installments, (total - outstanding) * amount AS paid_value,
  outstanding AS outstanding_installments, outstanding * amount AS outstanding_value, total AS total_installments, total * amount AS total_recurring_value,
  total * amount + one_off AS total_contract_value FROM a""")
def i14(ctx: Context) -> DataFrame:
    as_of = F.lit(ctx.as_of)
    running = contract(ctx).where((c("start_date") <= as_of) & (c("end_date") >= as_of)).withColumn(
        "one_off", F.when(c("k") == 0, c("arr")).otherwise(0.0))
    return outstanding(running, "start_date", "end_date", "k", "arr", "one_off", as_of).drop(
        "arr", "start_date", "end_date", "k", "one_off")


@query("i15_next_invoice", f"""
WITH RECURSIVE {CONTRACT},
run AS (SELECT contract.*, c_nationkey < 5 AS is_domestic, CASE WHEN k > 0 THEN arr / (12.0::DOUBLE / k) ELSE 0.0 END AS net FROM contract
        JOIN customer ON c_custkey = company_id WHERE {AS_OF} BETWEEN start_date AND end_date),
r AS (SELECT deal_id, start_date AS due_date, end_date, k, net, is_domestic FROM run
      UNION ALL SELECT deal_id, CASE WHEN day(due_date) > 1 THEN CAST(last_day(CAST(due_date + to_months(k) AS DATE)) + 1 AS DATE)
                                     ELSE CAST(due_date + to_months(k) AS DATE) END, end_date, k, net, is_domestic
      FROM r WHERE CAST(due_date + to_months(k) AS DATE) < end_date AND k >= 1),
inv AS (SELECT l_orderkey AS deal_id, CAST(l_shipdate AS DATE) AS d, l_linestatus = 'F' AS paid FROM lineitem)
SELECT r.deal_id, r.due_date AS date_key, max(net) AS net_amount, max(CASE WHEN is_domestic THEN net * (1 + 0.19::DOUBLE) ELSE net END) AS gross_amount,
  max(CASE WHEN inv.d < r.due_date THEN inv.d END) AS last_invoice_before, bool_and(CASE WHEN inv.d < r.due_date THEN paid END) AS paid_before,
  max(inv.d) AS last_invoice, max(net) > 750 AS is_big
FROM r LEFT JOIN inv ON inv.deal_id = r.deal_id GROUP BY r.deal_id, r.due_date""", text="date_key last_invoice_before last_invoice")
def i15(ctx: Context) -> DataFrame:
    domestic = ctx.table("customer").select(c("c_custkey").alias("company_id"), (c("c_nationkey") < 5).alias("is_domestic"))
    contracts = contract(ctx).join(domestic, "company_id")
    invoices = ctx.table("lineitem").select(c("l_orderkey").alias("deal_id"), c("l_shipdate").cast("date").alias("invoice_date"),
                                            (c("l_linestatus") == "F").alias("is_paid"))
    return rev.next_invoices(contracts, invoices, F.lit(ctx.as_of))


@query("i16_contracted_monthly", """
SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, CASE WHEN o_totalprice > 400000 THEN 'Deal ' || o_custkey ELSE 'other' END AS deal,
  round(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS gross_amount, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS net_amount
FROM orders WHERE o_orderpriority <> '5-LOW' OR nullif(o_orderstatus, 'P') IS NULL
GROUP BY 1, 2, 3 HAVING year(o_orderdate) IN (1996, 1997, 1998) ORDER BY 1, 2, 3""",
       num="gross_amount net_amount", ints="year month")
def i16(ctx: Context) -> DataFrame:
    """The payment schema is NULL for pending orders, and NULL stays in."""
    schema = F.when(c("o_orderstatus") == "P", F.lit(None)).when(c("o_orderpriority") == "5-LOW", "Credit model").otherwise("Invoice")
    rows = ctx.table("orders").select(
        c("o_orderdate").cast("date").alias("date_key"), money(c("o_totalprice")).alias("gross"), money(c("o_totalprice")).alias("net"),
        F.concat(F.lit("Deal "), c("o_custkey").cast("string")).alias("deal_name"), (c("o_totalprice") > 400000).alias("is_big"),
        schema.alias("payment_schema"))
    return rev.monthly_contracted(rows, [1996, 1997, 1998])


@query("i17_mrr_normalise", f"""
WITH {CONTRACT},
inv AS (SELECT company_id, company_id * 100 + k AS deal_sk, k, CAST(date_trunc('month', start_date) AS DATE) AS pf,
    last_day(CAST(date_trunc('month', start_date) + to_months(k - 1) AS DATE)) AS pt, CAST(round(arr / 100000) * 12 AS DECIMAL(18,2)) AS amount
  FROM contract WHERE k <> 0 AND round(arr / 100000) > 0),
d AS (SELECT company_id * 100 + k AS deal_sk, min(start_date) AS cs, CAST(max(start_date) + 400 AS DATE) AS ce FROM contract GROUP BY 1),
rk AS (SELECT inv.*, cs, ce, dense_rank() OVER (PARTITION BY inv.deal_sk, company_id ORDER BY pf) AS rn,
    dense_rank() OVER (PARTITION BY inv.deal_sk, company_id ORDER BY pf DESC) AS rd FROM inv JOIN d ON d.deal_sk = inv.deal_sk),
cl AS (SELECT *, CASE WHEN rn = 1 THEN coalesce(cs, pf) ELSE pf END AS cf, CASE WHEN rd = 1 AND ce > pt THEN ce ELSE pt END AS ct FROM rk),
s AS (SELECT company_id, cf, ct, CAST(coalesce(sum(amount) FILTER (WHERE k = 1), 0) AS DOUBLE) AS m, CAST(coalesce(sum(amount) FILTER (WHERE k = 3), 0) AS DOUBLE) AS q,
    CAST(coalesce(sum(amount) FILTER (WHERE k = 6), 0) AS DOUBLE) AS b, CAST(coalesce(sum(amount) FILTER (WHERE k = 12), 0) AS DOUBLE) AS a FROM cl GROUP BY ALL),
v AS (SELECT *, m AS mrr_month, q / 3 + m AS mrr_quarter, b / 6 + (q / 3 + m) AS mrr_biannual, a / 12 + (b / 6 + (q / 3 + m)) AS mrr_annual FROM s),
f AS (SELECT *, CASE WHEN mrr_annual = lag(mrr_annual) OVER w THEN 0 ELSE 1 END AS chg FROM v WINDOW w AS (PARTITION BY company_id ORDER BY cf, ct)),
n AS (SELECT *, sum(chg) OVER (PARTITION BY company_id ORDER BY cf, ct ROWS UNBOUNDED PRECEDING) AS island FROM f)
SELECT company_id AS company_sk, min(cf) AS valid_from, max(ct) AS valid_to, mrr_month, mrr_quarter, mrr_biannual, mrr_annual, mrr_quarter * 3 AS total_quarter,
  mrr_biannual * 6 AS total_biannual, mrr_annual * 12 AS total_annual FROM n GROUP BY company_id, mrr_month, mrr_quarter, mrr_biannual, mrr_annual, island""",
       text="valid_from valid_to")
def i17(ctx: Context) -> DataFrame:
    """Orders as invoices; amounts are coarse on purpose, so that neighbouring months repeat."""
    rows = contract(ctx).withColumn("deal_sk", c("company_id") * 100 + c("k"))
    deals = rows.groupBy("deal_sk").agg(F.min("start_date").alias("contract_start"), F.date_add(F.max("start_date"), 400).alias("contract_end"))
    invoices = rows.join(deals, "deal_sk").select(
        c("company_id").alias("company_sk"), "deal_sk", c("start_date").alias("period_from"),
        F.add_months(F.trunc("start_date", "month"), c("k") - 1).alias("period_to"), "contract_start", "contract_end",
        c("k").alias("payment_interval"), (F.round(c("arr") / 100000) * 12).alias("recurring_amount"))
    return rev.recurring_invoiced(invoices)


@query("i37_overdue_invoices", f"""
SELECT o_orderkey AS invoice_id, c_name AS company, CAST(o_orderdate + to_days(30) AS DATE) AS due_date, CASE WHEN o_orderpriority = '1-URGENT' THEN 2 END AS dunning_level,
  CAST(round(sum(CAST(o_totalprice AS DECIMAL(18,2)))) AS BIGINT) AS net_amount, date_diff('day', CAST(o_orderdate + to_days(30) AS DATE), {AS_OF}) AS days_overdue
FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'O' AND CAST(o_orderdate + to_days(30) AS DATE) < {AS_OF}
GROUP BY 1, 2, 3, 4 HAVING date_diff('day', CAST(o_orderdate + to_days(30) AS DATE), {AS_OF}) > 7""", text="due_date", ints="dunning_level")
def i37(ctx: Context) -> DataFrame:
    names = ctx.table("customer").select("c_custkey", c("c_name").alias("company"))
    rows = ctx.table("orders").join(names, c("c_custkey") == c("o_custkey"), "left").select(
        c("o_orderkey").alias("invoice_id"), "company", money(c("o_totalprice")).alias("net"),
        F.date_add(c("o_orderdate").cast("date"), 30).alias("due_date"), (c("o_orderstatus") != "O").alias("is_paid"),
        F.when(c("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("dunning"))
    return rev.overdue(rows, F.lit(ctx.as_of))


@query("i38_sepa_exports", """
SELECT 'debit' AS kind, o_orderkey AS document, CAST(o_orderdate AS DATE) AS document_date, CAST(o_orderdate + to_days(14) AS DATE) AS due_date,
  CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2))) * 100) AS BIGINT) AS amount_cents, c_name AS name, c_custkey + 1000000 AS number
FROM orders JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey
WHERE o_orderstatus = 'O' AND c_mktsegment = 'BUILDING' GROUP BY ALL
UNION ALL SELECT 'transfer', l_orderkey, CAST(l_shipdate AS DATE), CAST(l_shipdate + to_days(28) AS DATE),
  CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2))) * 100) AS BIGINT), s_name, s_suppkey
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey WHERE l_linestatus = 'O' AND l_returnflag = 'R' GROUP BY ALL""", text="document_date due_date")
def i38(ctx: Context) -> DataFrame:
    """Open direct debits (customers) and transfers (suppliers), amounts in whole cents."""
    lines = ctx.table("lineitem")
    debit = (ctx.table("orders").where("o_orderstatus = 'O'").join(ctx.table("customer").where("c_mktsegment = 'BUILDING'"), c("c_custkey") == c("o_custkey"))
             .join(lines.select("l_orderkey", "l_extendedprice"), c("l_orderkey") == c("o_orderkey"))
             .groupBy(c("o_orderkey").alias("document"), c("o_orderdate").cast("date").alias("document_date"), c("c_name").alias("name"),
                      (c("c_custkey") + 1000000).alias("number")).agg(rev.cents(c("l_extendedprice")).alias("amount_cents"))
             .withColumn("kind", F.lit("debit")).withColumn("due_date", F.date_add("document_date", 14)))
    sums = lines.where("l_linestatus = 'O' AND l_returnflag = 'R'").groupBy(
        c("l_orderkey").alias("document"), c("l_shipdate").cast("date").alias("document_date"), c("l_suppkey").alias("number")).agg(
        rev.cents(c("l_extendedprice")).alias("amount_cents"))
    transfer = (sums.join(ctx.table("supplier").select("s_suppkey", c("s_name").alias("name")), c("s_suppkey") == c("number"), "left")
                .drop("s_suppkey").withColumn("kind", F.lit("transfer")).withColumn("due_date", F.date_add("document_date", 28)))
    return union_all([debit, transfer])


@query("i39_expense_union", """
SELECT 'SC - ' || s_name AS description, CAST(NULL AS BIGINT) AS receipt_id, s_suppkey AS creditor_id, CAST(s_acctbal AS DECIMAL(18,2)) AS net, DATE '1998-11-01' AS date_key,
  CAST(DATE '1998-11-01' + 28 AS DATE) AS due_date, strftime(DATE '1998-11-01', '%m/%y') || '_salary' AS label, 'C' AS credit_debit, 'Personnel expenses' AS category, 'Paid' AS status
FROM supplier WHERE s_acctbal > 0
UNION ALL SELECT p_name, l_orderkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(18,2)), CAST(l_shipdate AS DATE), CAST(l_shipdate + to_days(14) AS DATE), NULL,
  CASE WHEN l_returnflag = 'R' THEN 'D' ELSE 'C' END, coalesce(CASE p_type WHEN 'ECONOMY' THEN 'Office' WHEN 'PROMO' THEN 'Marketing' END, 'Other'),
  CASE WHEN l_linestatus = 'F' THEN 'Paid' ELSE 'Unpaid/Due' END
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey WHERE s_acctbal <= 0""", text="date_key due_date", num="net")
def i39(ctx: Context) -> DataFrame:
    """Payroll rows as receipts (suppliers in credit stand for staff) plus real receipts without payroll contacts."""
    supplier, month = ctx.table("supplier"), F.lit("1998-11-01").cast("date")
    pay = supplier.where("s_acctbal > 0").select(
        F.concat(F.lit("SC - "), c("s_name")).alias("description"), c("s_suppkey").alias("creditor_id"), money(c("s_acctbal")).alias("net"),
        month.alias("date_key"), F.date_add(month, 28).alias("due_date"), F.concat(F.date_format(month, "MM/yy"), F.lit("_salary")).alias("label"),
        F.lit("C").alias("credit_debit"), F.lit("Personnel expenses").alias("category"), F.lit("Paid").alias("status"))
    kinds = ctx.spark.createDataFrame([("ECONOMY", "Office"), ("PROMO", "Marketing")], "p_kind string, kind string")
    lines = (ctx.table("lineitem").join(supplier.where("s_acctbal <= 0").select("s_suppkey"), c("s_suppkey") == c("l_suppkey"), "left_semi")
             .join(ctx.table("part").select("p_partkey", "p_name", "p_type"), c("p_partkey") == c("l_partkey")))
    lines = lookup_labels(lines, "p_type", kinds, "category", "Other")
    day = c("l_shipdate").cast("date")
    receipts = lines.select(
        c("p_name").alias("description"), c("l_orderkey").alias("receipt_id"), c("l_suppkey").alias("creditor_id"),
        money(c("l_extendedprice")).alias("net"), day.alias("date_key"), F.date_add(day, 14).alias("due_date"),
        F.when(c("l_returnflag") == "R", "D").otherwise("C").alias("credit_debit"), "category",
        F.when(c("l_linestatus") == "F", "Paid").otherwise("Unpaid/Due").alias("status"))
    return union_all([pay, receipts])


@query("i40_cancelled_filter", """
SELECT o_orderkey AS invoice_id, o_custkey AS company_id, CAST(o_totalprice AS DECIMAL(18,2)) AS net FROM orders
WHERE o_orderstatus <> 'P' AND o_orderpriority LIKE '%-%' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)
  AND o_orderdate >= TIMESTAMP '1996-01-01'
UNION SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) FROM orders WHERE o_orderdate < TIMESTAMP '1996-06-01' AND o_orderstatus <> 'P'""",
       num="net")
def i40(ctx: Context) -> DataFrame:
    """Invoices that are neither drafts nor cancelled, set-united with the legacy ones (the months overlap)."""
    rows = ctx.table("orders").where("o_orderstatus <> 'P'")
    cancelled = ctx.table("lineitem").where("l_returnflag = 'R' AND l_quantity > 45")
    valid = null_aware_anti(rows.where(c("o_orderpriority").like("%-%")), cancelled, "o_orderkey", "l_orderkey").where(
        "o_orderdate >= TIMESTAMP_NTZ'1996-01-01'")
    legacy = rows.where("o_orderdate < TIMESTAMP_NTZ'1996-06-01'")
    cols = [c("o_orderkey").alias("invoice_id"), c("o_custkey").alias("company_id"), money(c("o_totalprice")).alias("net")]
    return valid.select(*cols).union(legacy.select(*cols)).distinct()
