"""Queries for scalar functions (F)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.context import Context
from ledgerloom.functions import dates, geo, keys, logic, nested, text
from ledgerloom.operators.ordered import neighbours
from ledgerloom.plans.registry import query
from ledgerloom.plans.shapes import SITE, STAGE_HIST, hot_customers, site, stage_hist

c = F.col


@query("f01_string_basic", """
SELECT c_custkey, lower(c_name) AS low, upper(c_mktsegment) AS up, trim('  ' || c_name || ' ') AS trimmed,
       left(c_name, 8) AS head, right(c_name, 4) AS tail, length(c_mktsegment) AS len, replace(c_name, '#', '') AS plain,
       substring(c_name, 10) AS rest
FROM customer""")
def f01(ctx: Context) -> DataFrame:
    name = c("c_name")
    return ctx.table("customer").select(
        "c_custkey", F.lower(name).alias("low"), F.upper("c_mktsegment").alias("up"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"), F.left(name, F.lit(8)).alias("head"),
        F.right(name, F.lit(4)).alias("tail"), F.length("c_mktsegment").alias("len"),
        text.remove(name, "#").alias("plain"), text.strip_left(name, 9).alias("rest"))


@query("f02_split_part", """
SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', 9) AS deep, split_part(url, '://', 1) AS scheme
FROM pages""")
def f02(ctx: Context) -> DataFrame:
    return ctx.table("pages").select("page_id", text.split_part(c("url"), "/", 3).alias("host"),
                                     text.split_part(c("url"), "/", 9).alias("deep"),
                                     text.split_part(c("url"), "://", 1).alias("scheme"))


@query("f03_concat", """
SELECT o_orderkey, o_orderstatus || '-' || o_orderpriority AS joined,
       nullif(o_orderstatus, 'P') || '/' || CAST(o_custkey AS VARCHAR) AS strict
FROM orders""")
def f03(ctx: Context) -> DataFrame:
    return ctx.table("orders").select(
        "o_orderkey", text.concat_strict(c("o_orderstatus"), F.lit("-"), c("o_orderpriority")).alias("joined"),
        text.concat_strict(F.nullif(c("o_orderstatus"), F.lit("P")), F.lit("/"), c("o_custkey").cast("string")).alias("strict"))


@query("f04_initcap", """
SELECT p_partkey, upper(left(split_part(p_name, ' ', 1), 1)) || lower(substring(split_part(p_name, ' ', 1), 2)) || ' ' ||
       upper(left(split_part(p_name, ' ', 2), 1)) || lower(substring(split_part(p_name, ' ', 2), 2)) AS title
FROM part""")
def f04(ctx: Context) -> DataFrame:
    """Words are split at blanks only."""
    return ctx.table("part").select("p_partkey", F.initcap(F.upper("p_name")).alias("title"))


@query("f05_like_regex", """
SELECT page_id, url LIKE 'https://%' AS secure, url NOT LIKE '%?%' AS no_query,
       regexp_matches(url, '^https?://[a-z.]+/.*[0-9]+$') AS ends_in_number
FROM pages""")
def f05(ctx: Context) -> DataFrame:
    return ctx.table("pages").select(
        "page_id", c("url").like("https://%").alias("secure"), (~c("url").like("%?%")).alias("no_query"),
        text.regex_full(c("url"), "https?://[a-z.]+/.*[0-9]+").alias("ends_in_number"))


@query("f06_cast_try", """
SELECT c_custkey, TRY_CAST(split_part(c_name, '#', 2) AS BIGINT) AS number, TRY_CAST(c_name AS DOUBLE) AS junk,
       TRY_CAST(CASE WHEN c_nationkey > 12 THEN '2024-02-30' ELSE '2024-02-28' END AS DATE) AS maybe_day,
       CAST(round(c_acctbal) AS BIGINT) AS balance
FROM customer""", text="maybe_day")
def f06(ctx: Context) -> DataFrame:
    raw_day = F.when(c("c_nationkey") > 12, F.lit("2024-02-30")).otherwise(F.lit("2024-02-28"))
    return ctx.table("customer").select(
        "c_custkey", text.typed(F.split_part("c_name", F.lit("#"), F.lit(2)), "bigint").alias("number"),
        text.typed(c("c_name"), "double").alias("junk"), raw_day.try_cast("date").alias("maybe_day"),
        logic.round_int(c("c_acctbal")).alias("balance"))


@query("f07_date_parts", """
SELECT event_id, year(ts) AS y, month(ts) AS m, day(ts) AS d, hour(ts) AS h, CAST(date_trunc('month', ts) AS DATE) AS month_first,
       CAST(date_trunc('week', ts) AS DATE) AS week_first, last_day(CAST(ts AS DATE)) AS month_last, strftime(ts, '%m/%y') AS label
FROM events""", text="month_first week_first month_last")
def f07(ctx: Context) -> DataFrame:
    return ctx.table("events").select(
        "event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.day("ts").alias("d"), F.hour("ts").alias("h"),
        dates.month_first(c("ts")).alias("month_first"), dates.week_first(c("ts")).alias("week_first"),
        F.last_day("ts").alias("month_last"), F.date_format("ts", "MM/yy").alias("label"))


@query("f08_date_arith", """
SELECT o_orderkey, CAST(o_orderdate + to_days(30) AS DATE) AS due, CAST(o_orderdate + to_months(3) AS DATE) AS next_quarter,
       o_orderdate + to_hours(9) AS opens, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS age_days
FROM orders""", text="due next_quarter opens")
def f08(ctx: Context) -> DataFrame:
    d = c("o_orderdate").cast("date")
    return ctx.table("orders").select(
        "o_orderkey", F.date_add(d, 30).alias("due"), F.add_months(d, 3).alias("next_quarter"),
        (c("o_orderdate") + F.expr("INTERVAL 9 HOURS")).alias("opens"),
        F.date_diff(d, F.lit("1995-01-01").cast("date")).alias("age_days"))


@query("f09_boundary_diff", f"""
WITH {STAGE_HIST}
SELECT event_id, date_diff('minute', valid_from, valid_to) AS minutes, date_diff('hour', valid_from, valid_to) AS hours,
       date_diff('day', valid_from, valid_to) AS days
FROM stage_hist WHERE valid_to < TIMESTAMP '9999-12-31 00:00:00'""")
def f09(ctx: Context) -> DataFrame:
    hist = stage_hist(ctx).where(F.year("valid_to") < 9999)
    return hist.select("event_id", *[dates.boundary_diff(u, c("valid_from"), c("valid_to")).alias(u + "s")
                                     for u in ("minute", "hour", "day")])


@query("f10_timedelta", f"""
WITH {STAGE_HIST}, m AS (SELECT event_id, epoch_us(valid_to) - epoch_us(valid_from) AS us FROM stage_hist
                         WHERE valid_to < TIMESTAMP '9999-12-31 00:00:00')
SELECT event_id, us / 1000000.0::DOUBLE / 1.0::DOUBLE AS in_seconds, us / 1000000.0::DOUBLE / 60.0::DOUBLE AS in_minutes,
       us / 1000000.0::DOUBLE / 3600.0::DOUBLE AS in_hours, us / 1000000.0::DOUBLE / 86400.0::DOUBLE AS in_days
FROM m""")
def f10(ctx: Context) -> DataFrame:
    hist = stage_hist(ctx).where(F.year("valid_to") < 9999)
    return hist.select("event_id", *[dates.timedelta(c("valid_from"), c("valid_to"), p).alias("in_" + p)
                                     for p in ("seconds", "minutes", "hours", "days")])


@query("f11_timezone", """
SELECT event_id, timezone('Europe/Berlin', timezone('UTC', ts)) AS local_ts,
       CAST(timezone('Europe/Berlin', timezone('UTC', ts)) AS DATE) AS local_day,
       timezone('Europe/Berlin', timezone('UTC', ts + to_months(6))) AS summer_ts
FROM events""", text="local_ts local_day summer_ts")
def f11(ctx: Context) -> DataFrame:
    local = dates.to_local(c("ts"), ctx.tz)
    later = dates.to_local(c("ts") + F.expr("INTERVAL 6 MONTHS"), ctx.tz)
    return ctx.table("events").select("event_id", local.alias("local_ts"), local.cast("date").alias("local_day"),
                                      later.alias("summer_ts"))


@query("f12_math", """
SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice) AS rounded, abs(l_quantity - 25) AS off, power(l_quantity, 2) AS squared,
       CASE WHEN l_tax IS NULL OR nullif(l_discount, 0.05) IS NULL THEN NULL ELSE least(l_tax, nullif(l_discount, 0.05)) END AS low,
       greatest(l_tax, nullif(l_discount, 0.05)) AS high,
       CASE WHEN l_discount = 0 THEN 0.0::DOUBLE ELSE l_tax / l_discount END AS ratio
FROM lineitem""", ints="l_linenumber")
def f12(ctx: Context) -> DataFrame:
    """least_strict is NULL if any input is; the plain greatest skips NULLs."""
    disc = F.nullif(c("l_discount"), F.lit(0.05))
    return ctx.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round("l_extendedprice").alias("rounded"),
        F.abs(c("l_quantity") - 25).alias("off"), F.pow("l_quantity", F.lit(2.0)).alias("squared"),
        logic.least_strict(c("l_tax"), disc).alias("low"), F.greatest(c("l_tax"), disc).alias("high"),
        logic.div0(c("l_tax"), c("l_discount")).alias("ratio"))


@query("f13_json_path", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.a.b') AS missing,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_struct, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_variant
FROM events""")
def f13(ctx: Context) -> DataFrame:
    return ctx.table("events").select(
        "event_id", nested.json_path(c("props"), "k", "bigint").alias("k"),
        nested.json_path(c("props"), "a.b").alias("missing"),
        nested.parse_json(c("props"), "k bigint")["k"].alias("k_struct"),
        nested.variant_path(c("props"), "k", "bigint").alias("k_variant"))


@query("f14_array_access", """
WITH t AS (SELECT p_partkey, string_split(p_name, ' ') AS words FROM part)
SELECT p_partkey, words[1] AS first_word, words[5] AS fifth_word, len(words) AS n_words,
       array_to_string(words, '+') AS joined, list_contains(words, 'red') AS is_red
FROM t""")
def f14(ctx: Context) -> DataFrame:
    words = F.split("p_name", " ")
    return ctx.table("part").select(
        "p_partkey", nested.at(words, 0).alias("first_word"), nested.at(words, 4).alias("fifth_word"),
        nested.size0(words).alias("n_words"), F.array_join(words, "+").alias("joined"),
        nested.list_contains(c("p_name"), " ", "red").alias("is_red"))


@query("f15_row_hash", """
WITH t AS (SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus, nullif(o_orderpriority, '3-MEDIUM') AS prio FROM orders)
SELECT o_orderkey, o_custkey, row_number() OVER w = 1 OR o_orderstatus IS DISTINCT FROM lag(o_orderstatus) OVER w
       OR prio IS DISTINCT FROM lag(prio) OVER w AS is_change
FROM t WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def f15(ctx: Context) -> DataFrame:
    """Row differs from the one before it in any of several columns, some of them NULL."""
    t = ctx.table("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                                   F.nullif(c("o_orderpriority"), F.lit("3-MEDIUM")).alias("prio"))
    t = t.withColumn("here", F.struct("o_orderstatus", "prio"))
    out = neighbours(t, ["o_custkey"], ["o_orderdate", "o_orderkey"], hot_customers(ctx),
                     previous={"before": "here"})
    return out.select("o_orderkey", "o_custkey", (~c("here").eqNullSafe(c("before"))).alias("is_change"))


@query("f16_surrogate_md5", """
SELECT o_orderkey, md5(CAST(o_custkey AS VARCHAR) || '-' || coalesce(nullif(o_orderstatus, 'P'), '') || '-' ||
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR)) AS id
FROM orders""")
def f16(ctx: Context) -> DataFrame:
    return ctx.table("orders").select("o_orderkey", keys.surrogate_md5(
        c("o_custkey"), F.nullif(c("o_orderstatus"), F.lit("P")), c("o_orderdate").cast("date")).alias("id"))


@query("f17_geo_clean", f"""
WITH {SITE}, t AS (SELECT site_id, CASE WHEN abs(lon) > 1 THEN lon END AS lon, CASE WHEN abs(lat) > 1 THEN lat END AS lat FROM site)
SELECT site_id, lon, lat, CASE WHEN lon IS NOT NULL AND lat IS NOT NULL THEN lon END AS point_lon,
       lon IS NOT NULL AND lat IS NOT NULL AS has_point
FROM t""", num="lon lat point_lon")
def f17(ctx: Context) -> DataFrame:
    lon, lat = geo.clean_coordinate(c("lon")), geo.clean_coordinate(c("lat"))
    point = geo.geo_point(lon, lat)
    return site(ctx).select("site_id", lon.alias("lon"), lat.alias("lat"), point["lon"].alias("point_lon"),
                            point.isNotNull().alias("has_point"))


@query("f18_unit_normalise", """
SELECT p_partkey, round(CASE WHEN p_retailprice > 1000 THEN p_retailprice / 1000 ELSE p_retailprice END, 2) AS price FROM part""")
def f18(ctx: Context) -> DataFrame:
    return ctx.table("part").select("p_partkey", logic.normalise_unit(c("p_retailprice"), 1000, 1000).alias("price"))


@query("f19_sentinel_dates", """
WITH t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, coalesce(CASE WHEN nullif(d, DATE '1995-01-01') < DATE '1996-01-01' THEN DATE '1996-01-01'
         ELSE nullif(d, DATE '1995-01-01') END, DATE '2006-01-01') AS cleaned,
       CASE WHEN o_orderkey % 24 = 0 THEN 1439 ELSE (o_orderkey % 24) * 60 + 30 END AS minute_of_day
FROM t""", text="cleaned")
def f19(ctx: Context) -> DataFrame:
    hour = (c("o_orderkey") % 24).cast("int")
    clock = F.when(hour == 0, F.lit("24:00")).otherwise(F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":30")))
    return ctx.table("orders").select(
        "o_orderkey", dates.clean_date(c("o_orderdate"), "1995-01-01", "1996-01-01", "2006-01-01").alias("cleaned"),
        dates.clock_minutes(clock).alias("minute_of_day"))
