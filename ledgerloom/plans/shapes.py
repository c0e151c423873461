"""Business shapes derived from the given tables: histories, contracts, rates, sites and areas.

Each shape exists twice, as a DataFrame and as the SQL of the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.context import Context
from ledgerloom.functions.dates import open_end
from ledgerloom.functions.geo import box_ring
from ledgerloom.functions.logic import decode
from ledgerloom.operators.ordered import HotKeys, hot_keys, neighbours


def hot_entities(ctx: Context, key: str = "entity_id") -> HotKeys | None:
    """Users with too many events for one task, under the name their histories have for them."""
    hot = hot_keys("user_id", ctx.table("events"))
    return hot.named(key) if hot else None


def hot_customers(ctx: Context) -> HotKeys | None:
    """Customers with too many orders for one task."""
    return hot_keys("o_custkey", ctx.table("orders"))


def stage_versions(ctx: Context) -> DataFrame:
    """Stage history without an end: one version per event of a user."""
    return ctx.table("events").select(
        "event_id", F.col("user_id").alias("entity_id"), F.col("event_type").alias("stage"),
        F.col("ts").alias("valid_from"))


def stage_hist(ctx: Context) -> DataFrame:
    """Stage history with half-open versions; the last one stays open."""
    out = neighbours(stage_versions(ctx), ["entity_id"], ["valid_from", "event_id"], hot_entities(ctx),
                     following={"valid_to": "valid_from"})
    return out.withColumn("valid_to", F.coalesce("valid_to", open_end()))


STAGE_HIST = """stage_hist AS (
  SELECT event_id, user_id AS entity_id, event_type AS stage, ts AS valid_from,
         coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), TIMESTAMP '9999-12-31 00:00:00') AS valid_to
  FROM events)"""

# Months between two payments, by order priority; 0 is a one-time payment.
PAYMENT_MONTHS = {"1-URGENT": 1, "2-HIGH": 3, "3-MEDIUM": 6, "4-NOT SPECIFIED": 12}


def contract(ctx: Context) -> DataFrame:
    start = F.col("o_orderdate").cast("date")
    return ctx.table("orders").select(
        F.col("o_orderkey").alias("deal_id"), F.col("o_custkey").alias("company_id"),
        F.col("o_totalprice").alias("arr"), start.alias("start_date"),
        F.add_months(start, (6 + 6 * (F.col("o_orderkey") % 4)).cast("int")).alias("end_date"),
        decode(F.col("o_orderpriority"), PAYMENT_MONTHS, 0).alias("k"))


CONTRACT = """contract AS (
  SELECT o_orderkey AS deal_id, o_custkey AS company_id, o_totalprice AS arr, cast(o_orderdate AS date) AS start_date,
         cast(cast(o_orderdate AS date) + to_months(cast(6 + 6*(o_orderkey % 4) AS integer)) AS date) AS end_date,
         CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 6
              WHEN '4-NOT SPECIFIED' THEN 12 ELSE 0 END AS k
  FROM orders)"""


def rate_hist(ctx: Context) -> DataFrame:
    """Three hourly rates per user over the month, half-open, the last one open."""
    users = ctx.table("events").select(F.col("user_id").alias("owner_id")).distinct()
    version = F.explode(F.expr(
        "array(named_struct('n', 0, 'f', TIMESTAMP_NTZ'2024-01-01', 't', TIMESTAMP_NTZ'2024-01-11'),"
        "named_struct('n', 1, 'f', TIMESTAMP_NTZ'2024-01-11', 't', TIMESTAMP_NTZ'2024-01-21'),"
        "named_struct('n', 2, 'f', TIMESTAMP_NTZ'2024-01-21', 't', TIMESTAMP_NTZ'9999-12-31'))"))
    return users.withColumn("v", version).select(
        "owner_id", F.col("v.n").alias("n"),
        (10 + F.col("owner_id") % 7 + 2 * F.col("v.n")).cast("double").alias("rate"),
        F.col("v.f").alias("valid_from"), F.col("v.t").alias("valid_to"))


RATE_HIST = """rate_hist AS (
  SELECT u.user_id AS owner_id, v.n, cast(10 + (u.user_id % 7) + 2*v.n AS double) AS rate, v.f AS valid_from, v.t AS valid_to
  FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN (VALUES
    (0, TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-11'), (1, TIMESTAMP '2024-01-11', TIMESTAMP '2024-01-21'),
    (2, TIMESTAMP '2024-01-21', TIMESTAMP '9999-12-31')) v(n, f, t))"""


def site(ctx: Context) -> DataFrame:
    return ctx.table("customer").select(
        F.col("c_custkey").alias("site_id"), F.col("c_nationkey").alias("nation_id"),
        (F.col("c_custkey") * 37 % 3600 / 10.0 - 180).alias("lon"),
        (F.col("c_custkey") * 91 % 1800 / 10.0 - 90).alias("lat"), F.col("c_acctbal").alias("capacity"))


SITE = """site AS (
  SELECT c_custkey AS site_id, c_nationkey AS nation_id, (c_custkey * 37 % 3600) / 10.0 - 180 AS lon,
         (c_custkey * 91 % 1800) / 10.0 - 90 AS lat, c_acctbal AS capacity FROM customer)"""


def poly(ctx: Context) -> DataFrame:
    left = -180.0 + 14 * F.col("n_nationkey")
    return ctx.table("nation").select(
        F.col("n_nationkey").alias("country_id"),
        box_ring(left, F.lit(-60.0), left + 14, F.lit(60.0)).alias("ring"))


POLY = """poly AS (
  SELECT n_nationkey AS country_id, -180.0 + 14*n_nationkey AS min_lon, -180.0 + 14*n_nationkey + 14 AS max_lon,
         -60.0 AS min_lat, 60.0 AS max_lat FROM nation)"""
