"""Queries for sources, snapshots, incremental loads and sinks (S)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.context import Context, new_folder
from ledgerloom.functions.logic import money
from ledgerloom.plans.registry import query
from ledgerloom.sources.build import build_table, build_view, drop_deleted, extract, latest_batch, literal_df
from ledgerloom.sources.catalog import Catalog
from ledgerloom.sources.history import HistoryStore
from ledgerloom.sources.incremental import incremental_append
from ledgerloom.sources.snapshots import first_snapshot, snapshot_check, snapshot_timestamp
from ledgerloom.streaming.daily import daily_counts, latest_counts, run_to_folder

c = F.col


@query("s01_source_scan", "SELECT n_nationkey, n_name FROM nation", ints="n_nationkey")
def s01(ctx: Context) -> DataFrame:
    catalog = Catalog(ctx.spark, {"files": ctx.root}, overrides={("files", "countries"): f"{ctx.root}/nation.parquet"})
    return catalog.source("files", "countries").select("n_nationkey", "n_name")


@query("s02_build_table", """
SELECT o_orderstatus, year(o_orderdate) AS year, count(*) AS orders FROM orders GROUP BY ALL""", ints="year")
def s02(ctx: Context) -> DataFrame:
    rows = ctx.table("orders").select("o_orderstatus", F.year("o_orderdate").alias("year"))
    return build_table(rows, "orders_by_status").groupBy("o_orderstatus", "year").agg(F.count(F.lit(1)).alias("orders"))


@query("s03_build_view", """
SELECT c_mktsegment, count(*) AS customers FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment""")
def s03(ctx: Context) -> DataFrame:
    view = build_view(ctx.table("customer").where("c_acctbal > 0"), "ledgerloom_solvent_customers")
    return view.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))


@query("s04_latest_batch", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS load_date, o_totalprice AS cost, 'current' AS origin FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate IN (
  SELECT max(o_orderdate) FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY year(o_orderdate), month(o_orderdate))
UNION ALL SELECT o_orderkey, CAST(o_orderdate AS DATE), o_totalprice, 'history' FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'""",
       text="load_date")
def s04(ctx: Context) -> DataFrame:
    loads = ctx.table("orders").select("o_orderkey", c("o_orderdate").cast("date").alias("load_date"),
                                       c("o_totalprice").alias("cost"))
    current = loads.where("load_date >= DATE'1996-01-01'").withColumn("origin", F.lit("current"))
    history = loads.where("load_date < DATE'1996-01-01'").withColumn("origin", F.lit("history"))
    return latest_batch(current, "load_date", history)


_DAILY_SQL = "SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS count_queries FROM events GROUP BY ALL"


@query("s05_incremental_append", _DAILY_SQL, text="day")
def s05(ctx: Context) -> DataFrame:
    """Two loads of the event log; the second sees the whole log but adds only new days."""
    def build(df: DataFrame) -> DataFrame:
        return df.groupBy(F.to_date("ts").alias("day"), "user_id").agg(F.count(F.lit(1)).alias("count_queries"))
    events, target = ctx.table("events"), new_folder(ctx.spark, "api_tracking")
    incremental_append(events.where("ts < TIMESTAMP_NTZ'2024-01-16'"), target, "ts", "day", build)
    return incremental_append(events, target, "ts", "day", build).select("day", "user_id", "count_queries")


@query("s05_stream_append", _DAILY_SQL, text="day")
def s05_stream(ctx: Context) -> DataFrame:
    """The same counts from a stream over the log."""
    stream = (ctx.spark.readStream.schema(ctx.table("events").schema).option("pathGlobFilter", "events.parquet")
              .parquet(ctx.root))
    target = new_folder(ctx.spark, "api_stream")
    run_to_folder(daily_counts(stream, "ts", ["user_id"]), target, new_folder(ctx.spark, "api_stream_state"))
    return latest_counts(ctx.spark.read.parquet(target), ["user_id"])


def _accounts(ctx: Context) -> DataFrame:
    return ctx.table("customer").select("c_custkey", "c_name", money(c("c_acctbal")).alias("balance"), "c_mktsegment", "c_nationkey")


_S06_SQL = """
WITH s AS (SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(18,2)) AS balance, c_mktsegment AS seg, c_nationkey AS nation FROM customer),
old AS (SELECT c_custkey, c_name, balance, TIMESTAMP '2024-01-01' AS updated_at FROM s WHERE nation <> 24),
cur AS (SELECT c_custkey, c_name, CASE WHEN seg = 'BUILDING' THEN balance + 100 ELSE balance END AS balance,
          CASE WHEN seg = 'BUILDING' OR nation = 24 THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-01' END AS updated_at
        FROM s WHERE nation <> 0)
SELECT o.c_custkey, o.c_name, o.balance, o.updated_at, o.updated_at AS valid_from,
       CASE WHEN n.updated_at > o.updated_at THEN n.updated_at END AS valid_to FROM old o LEFT JOIN cur n USING (c_custkey)
UNION ALL
SELECT n.c_custkey, n.c_name, n.balance, n.updated_at, n.updated_at, NULL FROM cur n LEFT JOIN old o USING (c_custkey)
WHERE o.c_custkey IS NULL OR n.updated_at > o.updated_at"""


@query("s06_snapshot_timestamp", _S06_SQL, text="updated_at valid_from valid_to", num="balance")
def s06(ctx: Context) -> DataFrame:
    """Two states of the accounts: one segment changed, one country new, one country gone."""
    old, cur = _account_states(ctx)
    return snapshot_timestamp(first_snapshot(old, c("updated_at")), cur, "c_custkey", "updated_at")


def _account_states(ctx: Context) -> tuple[DataFrame, DataFrame]:
    jan, feb = F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"), F.expr("TIMESTAMP_NTZ'2024-02-01 00:00:00'")
    rows, cols = _accounts(ctx), ["c_custkey", "c_name", "balance", "updated_at"]
    old = rows.where("c_nationkey <> 24").withColumn("updated_at", jan).select(*cols)
    moved = c("c_mktsegment") == "BUILDING"
    cur = (rows.where("c_nationkey <> 0")
           .withColumn("balance", F.when(moved, c("balance") + 100).otherwise(c("balance")).cast("decimal(18,2)"))
           .withColumn("updated_at", F.when(moved | (c("c_nationkey") == 24), feb).otherwise(jan)).select(*cols))
    return old, cur


@query("s06_history_store", _S06_SQL, text="updated_at valid_from valid_to", num="balance")
def s06_store(ctx: Context) -> DataFrame:
    """The same history from a store that rewrites only buckets with a change; the second state is sent twice."""
    old, cur = _account_states(ctx)
    store = HistoryStore(ctx.spark, new_folder(ctx.spark, "accounts"), "c_custkey")
    store.apply(old, c("updated_at"), "january")
    store.apply(cur, c("updated_at"), "february")
    store.apply(cur, c("updated_at"), "february")
    return store.history()


@query("s06_change_stream", """
SELECT user_id, event_id, event_type AS stage, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to FROM events""", text="valid_from valid_to")
def s06_stream(ctx: Context) -> DataFrame:
    """Stage versions of users from a change stream that grows between three runs."""
    events = ctx.table("events").select("user_id", "event_id", c("event_type").alias("stage"), "ts")
    arrived, seen = new_folder(ctx.spark, "changes"), new_folder(ctx.spark, "changes-seen")
    store = HistoryStore(ctx.spark, new_folder(ctx.spark, "stages"), "user_id")
    for days in ("ts < TIMESTAMP_NTZ'2024-01-10'", "ts >= TIMESTAMP_NTZ'2024-01-10' AND ts < TIMESTAMP_NTZ'2024-01-20'", "ts >= TIMESTAMP_NTZ'2024-01-20'"):
        events.where(days).write.mode("append").parquet(arrived)
        store.follow(ctx.spark.readStream.schema(events.schema).parquet(arrived), c("ts"), seen)
    return store.history().select("user_id", "event_id", "stage", "valid_from", "valid_to")


_S07_SQL = """
WITH old AS (SELECT s_suppkey, s_name, nullif(s_nationkey, 3) AS nation, CAST(s_acctbal AS DECIMAL(18,2)) AS balance FROM supplier WHERE s_nationkey <> 24),
cur AS (SELECT s_suppkey, s_name, s_nationkey AS nation, CAST(CASE WHEN s_acctbal < 0 THEN 0 ELSE s_acctbal END AS DECIMAL(18,2)) AS balance FROM supplier),
j AS (SELECT o.s_suppkey AS ok, n.s_suppkey AS nk, o.s_name AS oname, n.s_name AS nname, o.nation AS onation, n.nation AS nnation,
        o.balance AS obal, n.balance AS nbal, o.nation IS DISTINCT FROM n.nation OR o.balance IS DISTINCT FROM n.balance AS diff
      FROM old o FULL JOIN cur n ON o.s_suppkey = n.s_suppkey)
SELECT ok AS s_suppkey, oname AS s_name, onation AS nation, obal AS balance, TIMESTAMP '2024-01-01' AS valid_from,
       CASE WHEN diff THEN TIMESTAMP '2024-03-01' END AS valid_to FROM j WHERE ok IS NOT NULL
UNION ALL SELECT nk, nname, nnation, nbal, TIMESTAMP '2024-03-01', NULL FROM j WHERE ok IS NULL OR diff"""


@query("s07_snapshot_check", _S07_SQL,
       text="valid_from valid_to", num="balance", ints="nation")
def s07(ctx: Context) -> DataFrame:
    old, cur = _supplier_states(ctx)
    history = first_snapshot(old, F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"))
    return snapshot_check(history, cur, "s_suppkey", ["nation", "balance"], F.expr("TIMESTAMP_NTZ'2024-03-01 00:00:00'"))


@query("s07_history_store", _S07_SQL, text="valid_from valid_to", num="balance", ints="nation")
def s07_store(ctx: Context) -> DataFrame:
    """The same history from a store, by comparing whole states."""
    old, cur = _supplier_states(ctx)
    store = HistoryStore(ctx.spark, new_folder(ctx.spark, "suppliers"), "s_suppkey", buckets=16)
    store.apply_state(old, ["nation", "balance"], F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"), "january")
    store.apply_state(cur, ["nation", "balance"], F.expr("TIMESTAMP_NTZ'2024-03-01 00:00:00'"), "march")
    return store.history()


def _supplier_states(ctx: Context) -> tuple[DataFrame, DataFrame]:
    rows = ctx.table("supplier")
    old = rows.where("s_nationkey <> 24").select(
        "s_suppkey", "s_name", F.nullif(c("s_nationkey"), F.lit(3)).alias("nation"), money(c("s_acctbal")).alias("balance"))
    cur = rows.select("s_suppkey", "s_name", c("s_nationkey").alias("nation"),
                      money(F.when(c("s_acctbal") < 0, 0.0).otherwise(c("s_acctbal"))).alias("balance"))
    return old, cur


@query("s08_inline_relation", """
SELECT p.due_days, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
FROM orders JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 3), ('3-MEDIUM', 14), ('5-LOW', 60)) p(priority, due_days)
  ON o_orderpriority = p.priority GROUP BY p.due_days""", num="revenue", ints="due_days")
def s08(ctx: Context) -> DataFrame:
    """Literal rows as a relation, joined to the orders."""
    rows = literal_df(ctx.spark, "priority string, due_days int",
                      [("1-URGENT", 1), ("2-HIGH", 3), ("3-MEDIUM", 14), ("5-LOW", 60)])
    return (ctx.table("orders").join(rows, c("o_orderpriority") == c("priority")).groupBy("due_days")
            .agg(F.count(F.lit(1)).alias("orders"), F.sum(money(c("o_totalprice"))).alias("revenue")))


# Fixed contract of the outbound customer file: order, names and types.
CUSTOMER_EXTRACT = T.StructType([
    T.StructField("company_id", T.LongType(), False), T.StructField("company_name", T.StringType(), True),
    T.StructField("total_orders", T.IntegerType(), False), T.StructField("total_revenue", T.DecimalType(18, 2), True),
    T.StructField("last_order", T.DateType(), True)])


@query("s09_contract_extract", """
SELECT c_custkey AS company_id, c_name AS company_name, count(o_orderkey) AS total_orders,
       sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total_revenue, coalesce(CAST(max(o_orderdate) AS DATE), DATE '2000-01-01') AS last_order
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name""", text="last_order", num="total_revenue")
def s09(ctx: Context) -> DataFrame:
    sums = ctx.table("orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum(money(c("o_totalprice"))).alias("total_revenue"),
        F.max("o_orderdate").alias("last_order"))
    rows = ctx.table("customer").join(sums, c("c_custkey") == c("o_custkey"), "left").select(
        c("c_name").alias("company_name"), c("c_custkey").alias("company_id"),
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"), "total_revenue",
        F.coalesce(c("last_order").cast("date"), F.lit("2000-01-01").cast("date")).alias("last_order"))
    return extract(rows, CUSTOMER_EXTRACT)


@query("s10_deleted_key_filter", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def s10(ctx: Context) -> DataFrame:
    hist = ctx.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return drop_deleted(hist, ctx.table("customer").where("c_acctbal > 0"), "o_custkey", "c_custkey")
