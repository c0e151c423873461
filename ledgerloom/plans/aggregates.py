"""Queries for aggregation (A) and window functions (W)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.context import Context
from ledgerloom.functions.dates import month_first
from ledgerloom.functions.logic import div0, money
from ledgerloom.functions.nested import associations, ids_of, size0
from ledgerloom.operators import aggregate, ordered
from ledgerloom.operators.distinct import count_states, dense_ids, distinct_states, merged_states, trailing_states
from ledgerloom.operators.ranks import row_number_keys, surrogate_rank
from ledgerloom.plans.registry import query
from ledgerloom.plans.shapes import hot_customers
from ledgerloom.sources.build import build_table


def price() -> Column:
    return money(F.col("o_totalprice"))


@query("a01_group_agg", """
SELECT l_returnflag, l_linestatus, count(*) AS lines, count(l_tax) AS taxed, min(l_shipdate) AS first_ship,
       max(l_quantity) AS max_quantity, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS price,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_quantity
FROM lineitem GROUP BY l_returnflag, l_linestatus""", text="first_ship", num="price")
def a01(ctx: Context) -> DataFrame:
    return ctx.table("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"), F.count("l_tax").alias("taxed"), F.min("l_shipdate").alias("first_ship"),
        F.max("l_quantity").alias("max_quantity"), F.sum(money(F.col("l_extendedprice"))).alias("price"),
        (F.sum(money(F.col("l_quantity"))).cast("double") / F.count(F.lit(1))).alias("avg_quantity"))


@query("a02_count_distinct", """
SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderpriority) AS priorities
FROM orders GROUP BY o_orderstatus""")
def a02(ctx: Context) -> DataFrame:
    return ctx.table("orders").groupBy("o_orderstatus").agg(
        F.count_distinct("o_custkey").alias("customers"), F.count_distinct("o_orderpriority").alias("priorities"))


@query("a03_conditional_agg", """
SELECT o_custkey, coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F'), 0) AS filled,
       count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent,
       count(DISTINCT CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END) AS open_priorities
FROM orders GROUP BY o_custkey""", num="filled")
def a03(ctx: Context) -> DataFrame:
    is_open = F.col("o_orderstatus") == "O"
    return ctx.table("orders").groupBy("o_custkey").agg(
        aggregate.sum_if(F.col("o_orderstatus") == "F", price()).alias("filled"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        aggregate.count_distinct_if(is_open, F.col("o_orderpriority")).alias("open_priorities"))


@query("a04_listagg", """
SELECT o_custkey, nullif(string_agg(DISTINCT o_orderpriority, ';' ORDER BY o_orderpriority), '') AS priorities
FROM orders GROUP BY o_custkey""")
def a04(ctx: Context) -> DataFrame:
    return aggregate.listagg_distinct(ctx.table("orders"), ["o_custkey"], "o_orderpriority", ";", "priorities")


@query("a05_bool_agg", """
SELECT o_custkey, bool_or(o_orderstatus = 'P') AS any_pending, bool_and(o_totalprice > 1000) AS all_above,
       bool_or(CASE WHEN o_orderstatus = 'F' THEN o_totalprice > 300000 END) AS any_large_filled
FROM orders GROUP BY o_custkey""")
def a05(ctx: Context) -> DataFrame:
    return ctx.table("orders").groupBy("o_custkey").agg(
        F.bool_or(F.col("o_orderstatus") == "P").alias("any_pending"),
        F.bool_and(F.col("o_totalprice") > 1000).alias("all_above"),
        F.bool_or(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") > 300000)).alias("any_large_filled"))


@query("a06_rollup_partial", """
SELECT year(o_orderdate) AS year, CASE WHEN grouping(p) = 1 THEN 'All (aggregated)' ELSE p END AS priority,
       count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
FROM (SELECT *, coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), '(none)') AS p FROM orders) t
GROUP BY year(o_orderdate), ROLLUP(p)""", num="revenue", ints="year")
def a06(ctx: Context) -> DataFrame:
    orders = ctx.table("orders").select(
        F.year("o_orderdate").alias("year"), F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("priority"),
        price().alias("price"))
    return aggregate.rollup_on(orders, ["year"], "priority",
                               [F.count(F.lit(1)).alias("orders"), F.sum("price").alias("revenue")])


STAGES = {"signup_at": "signup", "view_at": "view", "click_at": "click", "purchase_at": "purchase", "error_at": "error"}


@query("a07_pivot_first_time", """
SELECT user_id, min(ts) FILTER (WHERE event_type = 'signup') AS signup_at, min(ts) FILTER (WHERE event_type = 'view') AS view_at,
  min(ts) FILTER (WHERE event_type = 'click') AS click_at, min(ts) FILTER (WHERE event_type = 'purchase') AS purchase_at,
  min(ts) FILTER (WHERE event_type = 'error') AS error_at
FROM events GROUP BY user_id""", text="signup_at view_at click_at purchase_at error_at")
def a07(ctx: Context) -> DataFrame:
    return aggregate.pivot_min(ctx.table("events"), ["user_id"], "event_type", "ts", STAGES)


@query("a08_unpivot", """
SELECT p_partkey, 'retail' AS measure, p_retailprice AS value FROM part WHERE p_retailprice IS NOT NULL
UNION ALL SELECT p_partkey, 'size_above_25', CAST(CASE WHEN p_size > 25 THEN p_size END AS DOUBLE) FROM part WHERE p_size > 25""")
def a08(ctx: Context) -> DataFrame:
    wide = ctx.table("part").select("p_partkey", F.col("p_retailprice").alias("retail"),
                                    F.when(F.col("p_size") > 25, F.col("p_size").cast("double")).alias("size_above_25"))
    return aggregate.unpivot(wide, ["p_partkey"], ["retail", "size_above_25"], "measure", "value")


@query("a09_array_agg", """
WITH t AS (SELECT o_orderkey, list_sort(list_filter([CASE WHEN o_orderstatus <> 'P' THEN o_custkey END, o_custkey + 7, CASE WHEN o_totalprice > 200000 THEN o_custkey - 3 END],
             lambda x: x IS NOT NULL)) AS companies, CASE WHEN o_orderstatus = 'O' THEN [o_orderkey % 10] ELSE [] END AS tickets FROM orders)
SELECT o_orderkey, companies AS company_ids, len(companies) AS n_companies, tickets AS ticket_ids, len(companies) + len(tickets) AS n_links FROM t""")
def a09(ctx: Context) -> DataFrame:
    """Ids per association type out of the JSON array of {id, type} a CRM row carries. The array belongs to its
    row, so it is filtered and sorted in place and no group is ever collected."""
    links = associations(F.to_json(F.filter(_links(), lambda a: a["id"].isNotNull())))
    companies, tickets = ids_of(links, "company"), ids_of(links, "ticket")
    return ctx.table("orders").select("o_orderkey", companies.alias("company_ids"), size0(companies).alias("n_companies"),
                                      tickets.alias("ticket_ids"), size0(links).alias("n_links"))


def _links() -> Column:
    def link(ident: Column, kind: str) -> Column:
        return F.struct(ident.cast("string").alias("id"), F.lit(kind).alias("type"))
    cust, status = F.col("o_custkey"), F.col("o_orderstatus")
    return F.array(link(cust + 7, "company"), link(F.when(status != "P", cust), "company"),
                   link(F.when(F.col("o_totalprice") > 200000, cust - 3), "company"),
                   link(F.when(status == "O", F.col("o_orderkey") % 10), "ticket"))


@query("a10_debit_credit_long", """
WITH t AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_returnflag AS category,
             sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS c1, sum(CAST(l_quantity AS DECIMAL(18,2))) AS c2,
             sum(CAST(l_discount AS DECIMAL(18,2))) AS d1, sum(CAST(l_tax AS DECIMAL(18,2))) AS d2
           FROM lineitem GROUP BY ALL)
SELECT month, category, 'C' AS credit_debit, c1 AS booked, c2 AS balance FROM t
UNION ALL SELECT month, category, 'D', d1, d2 FROM t""", text="month", num="booked balance")
def a10(ctx: Context) -> DataFrame:
    lines = ctx.table("lineitem").select(
        month_first(F.col("l_shipdate")).alias("month"), F.col("l_returnflag").alias("category"),
        money(F.col("l_extendedprice")).alias("c1"), money(F.col("l_quantity")).alias("c2"),
        money(F.col("l_discount")).alias("d1"), money(F.col("l_tax")).alias("d2"))
    return aggregate.debit_credit(lines, ["month", "category"], ["c1", "c2"], ["d1", "d2"], ["booked", "balance"])


@query("w01_row_number", """
SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
FROM orders""")
def w01(ctx: Context) -> DataFrame:
    orders = ctx.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return ordered.row_numbers(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], hot_customers(ctx)).drop("o_orderdate")


@query("w02_dense_rank", """
SELECT o_orderkey, o_custkey, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS rank_asc,
       dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS rank_desc
FROM orders""")
def w02(ctx: Context) -> DataFrame:
    orders = ctx.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return ordered.dense_ranks(orders, ["o_custkey"], "o_orderdate", hot_customers(ctx), "rank_asc",
                               "rank_desc").drop("o_orderdate")


@query("w03_lag_lead", """
WITH m AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id, day, n, coalesce(lag(n) OVER w, 0) AS before, lead(n) OVER w AS after,
       lead(day) OVER w AS next_day
FROM m WINDOW w AS (PARTITION BY user_id ORDER BY day)""", text="day next_day")
def w03(ctx: Context) -> DataFrame:
    """LAG with a default and LEAD over an aggregate: one row per user and day, so no user is ever large."""
    daily = ctx.table("events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    out = ordered.neighbours(daily, ["user_id"], ["day"], None,
                             previous={"before": "n"}, following={"after": "n", "next_day": "day"})
    return out.withColumn("before", F.coalesce("before", F.lit(0)))


@query("w04_first_last_value", """
SELECT o_orderkey, o_custkey, first_value(o_orderstatus) OVER w AS first_status, last_value(o_totalprice) OVER w AS last_price
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def w04(ctx: Context) -> DataFrame:
    orders = ctx.table("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    out = ordered.with_first_last(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"],
                                  first={"first_status": "o_orderstatus"}, last={"last_price": "o_totalprice"})
    return out.select("o_orderkey", "o_custkey", "first_status", "last_price")


@query("w05_running_sum", """
SELECT o_orderkey, o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey
         ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS revenue_to_date
FROM orders""", num="revenue_to_date")
def w05(ctx: Context) -> DataFrame:
    orders = ctx.table("orders").select("o_orderkey", "o_custkey", "o_orderdate", price().alias("price"))
    out = ordered.running_sum(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], hot_customers(ctx), "price",
                              "revenue_to_date")
    return out.select("o_orderkey", "o_custkey", "revenue_to_date")


@query("w06_ratio_to_total", """
WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority AS priority,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
             sum(CAST(o_totalprice AS DECIMAL(18,2))) AS exact FROM orders GROUP BY ALL)
SELECT month, priority, revenue, CASE WHEN CAST(sum(exact) OVER (PARTITION BY month) AS DOUBLE) = 0 THEN 0.0
       ELSE revenue / CAST(sum(exact) OVER (PARTITION BY month) AS DOUBLE) END AS share
FROM m""", text="month")
def w06(ctx: Context) -> DataFrame:
    monthly = ctx.table("orders").groupBy(month_first(F.col("o_orderdate")).alias("month"),
                                          F.col("o_orderpriority").alias("priority")).agg(F.sum(price()).alias("exact"))
    out = ordered.with_totals(monthly, ["month"], F.sum("exact").alias("total"))
    return out.select("month", "priority", F.col("exact").cast("double").alias("revenue"),
                      div0(F.col("exact").cast("double"), F.col("total").cast("double")).alias("share"))


@query("w07_partition_min_max", """
SELECT o_orderkey, o_custkey, min(o_orderdate) OVER p AS first_order, max(o_totalprice) OVER p AS max_price,
       count(*) OVER p AS n_orders
FROM orders WINDOW p AS (PARTITION BY o_custkey)""", text="first_order")
def w07(ctx: Context) -> DataFrame:
    orders = ctx.table("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    out = ordered.with_totals(orders, ["o_custkey"], F.min("o_orderdate").alias("first_order"),
                              F.max("o_totalprice").alias("max_price"), F.count(F.lit(1)).alias("n_orders"))
    return out.drop("o_orderdate", "o_totalprice")


@query("w08_count_distinct_over", """
SELECT l_orderkey, l_linenumber, l_suppkey, count(DISTINCT l_suppkey) OVER p AS suppliers, count(*) OVER p AS lines
FROM lineitem WINDOW p AS (PARTITION BY l_orderkey)""", ints="l_linenumber")
def w08(ctx: Context) -> DataFrame:
    lines = ctx.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return ordered.with_totals(lines, ["l_orderkey"], F.count_distinct("l_suppkey").alias("suppliers"),
                               F.count(F.lit(1)).alias("lines"))


@query("w09_global_surrogate_key", """
SELECT o_orderkey, dense_rank() OVER (ORDER BY o_custkey) AS customer_sk,
       row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_sk
FROM orders""")
def w09(ctx: Context) -> DataFrame:
    orders = ctx.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    out = surrogate_rank(orders, ["o_custkey"], "customer_sk")
    return row_number_keys(out, ["o_orderdate", "o_orderkey"], "order_sk").select("o_orderkey", "customer_sk", "order_sk")


@query("w10_named_window", """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id, day, n, row_number() OVER w AS day_no, sum(n) OVER w AS events_to_date
FROM d WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING)""", text="day", ints="events_to_date")
def w10(ctx: Context) -> DataFrame:
    """Two functions over one window definition. The input is one row per user and calendar day, so a
    user's partition is bounded by the calendar and a plain window is the right plan."""
    daily = ctx.table("events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("user_id").orderBy(F.col("day").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("user_id", "day", "n", F.row_number().over(w).alias("day_no"),
                        F.sum("n").over(w).alias("events_to_date"))




def _user_states(ctx: Context) -> DataFrame:
    """Users of each event type and day, as written states."""
    rows = ctx.table("events").select("event_type", "user_id", F.to_date("ts").alias("day"))
    return build_table(distinct_states(dense_ids(rows, [], "user_id", "user_no"), ["event_type", "day"], "user_no"), "user-states")


@query("a02_distinct_daily", "SELECT event_type, CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS users FROM events GROUP BY ALL", text="day")
def a02_daily(ctx: Context) -> DataFrame:
    """Distinct users a day, from stored states."""
    return count_states(_user_states(ctx), ["event_type", "day"], "users")


@query("a02_distinct_monthly", "SELECT CAST(date_trunc('month', ts) AS DATE) AS month, count(DISTINCT user_id) AS users FROM events GROUP BY ALL", text="month")
def a02_monthly(ctx: Context) -> DataFrame:
    """Distinct users a month over all event types, from the states of single days and types: no event is read again."""
    states = _user_states(ctx).withColumn("month", F.trunc("day", "month"))
    return count_states(merged_states(states, ["month"]), ["month"], "users")


@query("a02_distinct_trailing", """
WITH e AS (SELECT DISTINCT event_type, user_id, CAST(ts AS DATE) AS day FROM events),
d AS (SELECT event_type, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM e GROUP BY event_type)
SELECT d.event_type, d.day, count(DISTINCT user_id) AS users FROM d JOIN e ON e.event_type = d.event_type AND e.day BETWEEN d.day - 6 AND d.day GROUP BY ALL""", text="day")
def a02_trailing(ctx: Context) -> DataFrame:
    """Distinct users of the seven days up to each day, from the same states."""
    return count_states(trailing_states(_user_states(ctx), ["event_type"], "day", 7), ["event_type", "day"], "users")
