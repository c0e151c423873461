"""Queries for projection, filtering, set operations and masking (P, U)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.context import Context
from ledgerloom.functions.logic import bucket, classify, decode, flag, iff, money
from ledgerloom.functions.text import pseudonymise, seq_label
from ledgerloom.operators import project
from ledgerloom.operators.ordered import first_per_key
from ledgerloom.plans.registry import query
from ledgerloom.plans.shapes import STAGE_HIST, stage_hist


@query("p01_typed_projection", """
SELECT c_custkey AS company_id, nullif(c_name, '') AS company_name, c_nationkey AS country_id,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_acctbal AS DECIMAL(10,2)) END AS balance,
       CAST(NULL AS BIGINT) AS segment_no
FROM customer""", num="balance", ints="country_id")
def p01(ctx: Context) -> DataFrame:
    """Raw text columns (as an extract would deliver them) to typed ones; '' is NULL, junk is NULL."""
    balance = F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.col("c_acctbal").cast("string"))
    raw = ctx.table("customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("string").alias("country"), balance.alias("balance"),
        F.col("c_mktsegment").alias("segment"))
    return project.typed_select(raw, {
        "company_id": ("id", "bigint"), "company_name": ("name", "string"), "country_id": ("country", "int"),
        "balance": ("balance", "decimal(10,2)"), "segment_no": ("segment", "bigint")})


@query("p02_star_except", "SELECT * EXCLUDE (o_orderdate, o_orderpriority) FROM orders")
def p02(ctx: Context) -> DataFrame:
    return project.star_except(ctx.table("orders"), ["o_orderdate", "o_orderpriority"])


@query("p03_conditional", """
SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN 'big' ELSE 'small' END AS size_class,
       CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE 'pending' END AS status_name,
       CASE WHEN o_orderpriority = '1-URGENT' THEN TRUE ELSE FALSE END AS is_urgent,
       nullif(o_orderstatus, 'P') IS NOT NULL AS is_decided
FROM orders""")
def p03(ctx: Context) -> DataFrame:
    status = F.col("o_orderstatus")
    return ctx.table("orders").select(
        "o_orderkey", iff(F.col("o_totalprice") > 100000, F.lit("big"), F.lit("small")).alias("size_class"),
        F.when(status == "O", "open").when(status == "F", "filled").otherwise("pending").alias("status_name"),
        flag(F.col("o_orderpriority") == "1-URGENT").alias("is_urgent"),
        F.nullif(status, F.lit("P")).isNotNull().alias("is_decided"))


# Labels of the order priority codes; the lowest priority takes the default.
PRIORITY_LABELS = {"1-URGENT": "now", "2-HIGH": "today", "3-MEDIUM": "this week", "4-NOT SPECIFIED": "some day"}


@query("p04_code_lookup", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'today'
         WHEN '3-MEDIUM' THEN 'this week' WHEN '4-NOT SPECIFIED' THEN 'some day' ELSE 'unknown' END AS due,
       coalesce(n_name, 'UNKNOWN') AS country
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def p04(ctx: Context) -> DataFrame:
    """Short fixed code lists become CASE, code tables a join with a default."""
    orders = ctx.table("orders").join(ctx.table("customer").select("c_custkey", "c_nationkey"),
                                      F.col("o_custkey") == F.col("c_custkey"), "left")
    out = project.lookup_labels(orders, "c_nationkey", ctx.table("nation").select("n_nationkey", "n_name"),
                                "country", "UNKNOWN")
    return out.select("o_orderkey", decode(F.col("o_orderpriority"), PRIORITY_LABELS, "unknown").alias("due"), "country")


@query("p05_pattern_classify", """
SELECT p_partkey, CASE WHEN lower(p_name) LIKE '%widget%' THEN 'Widget' WHEN lower(p_name) LIKE 'red%' THEN 'Red thing'
       WHEN lower(p_name) LIKE '%bolt' THEN 'Fastener' ELSE 'Other' END AS part_class
FROM part""")
def p05(ctx: Context) -> DataFrame:
    ladder = [("%widget%", "Widget"), ("red%", "Red thing"), ("%bolt", "Fastener")]
    return ctx.table("part").select("p_partkey", classify(F.col("p_name"), ladder, "Other").alias("part_class"))


@query("p06_range_bucket", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '(pending)' WHEN o_totalprice <= 50000 THEN 'a. small'
       WHEN o_totalprice <= 200000 THEN 'b. medium' ELSE 'c. large' END AS size_class
FROM orders""")
def p06(ctx: Context) -> DataFrame:
    size = bucket(F.col("o_totalprice"), [50000, 200000], ["a. small", "b. medium", "c. large"])
    return ctx.table("orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "(pending)")
                                      .otherwise(size).alias("size_class"))


@query("p07_predicates", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag FROM lineitem
WHERE l_returnflag IN ('A', 'N') AND l_quantity BETWEEN 10 AND 40 AND NOT (l_linestatus = 'F' AND l_discount > 0.05)
  AND l_returnflag NOT IN ('R') AND (l_tax IS NOT NULL OR l_shipdate IS NULL) AND l_linestatus LIKE 'O%'""",
       ints="l_linenumber")
def p07(ctx: Context) -> DataFrame:
    c = F.col
    return ctx.table("lineitem").where(
        c("l_returnflag").isin("A", "N") & c("l_quantity").between(10, 40)
        & ~((c("l_linestatus") == "F") & (c("l_discount") > 0.05)) & ~c("l_returnflag").isin("R")
        & (c("l_tax").isNotNull() | c("l_shipdate").isNull()) & c("l_linestatus").like("O%")
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")


@query("p08_null_handling", """
WITH t AS (SELECT c.c_custkey, nullif(c.c_mktsegment, 'BUILDING') AS segment, o.last_status
           FROM customer c LEFT JOIN (SELECT o_custkey, max(o_orderstatus) AS last_status FROM orders
                                      WHERE o_totalprice > 300000 GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey)
SELECT c_custkey, coalesce(segment, '(none)') AS segment, coalesce(last_status, segment, '-') AS first_known,
       segment IS DISTINCT FROM last_status AS differs
FROM t""")
def p08(ctx: Context) -> DataFrame:
    last = ctx.table("orders").where("o_totalprice > 300000").groupBy("o_custkey").agg(
        F.max("o_orderstatus").alias("last_status"))
    t = (ctx.table("customer").withColumn("segment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
         .join(last, F.col("c_custkey") == F.col("o_custkey"), "left"))
    return t.select("c_custkey", F.coalesce("segment", F.lit("(none)")).alias("segment"),
                    F.coalesce("last_status", "segment", F.lit("-")).alias("first_known"),
                    (~F.col("segment").eqNullSafe(F.col("last_status"))).alias("differs"))


@query("p09_current_rows", f"WITH {STAGE_HIST} SELECT event_id, entity_id, stage FROM stage_hist "
                           "WHERE valid_to = TIMESTAMP '9999-12-31 00:00:00'")
def p09(ctx: Context) -> DataFrame:
    return project.current(stage_hist(ctx))


@query("p10_dedup_latest", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) t
WHERE rn = 1""", text="o_orderdate")
def p10(ctx: Context) -> DataFrame:
    latest = first_per_key(ctx.table("orders"), ["o_custkey"],
                           [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc_nulls_last()])
    return latest.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


@query("p11_dynamic_columns", """
SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS num_click,
  count(*) FILTER (WHERE event_type = 'error') AS num_error, count(*) FILTER (WHERE event_type = 'purchase') AS num_purchase,
  count(*) FILTER (WHERE event_type = 'signup') AS num_signup, count(*) FILTER (WHERE event_type = 'view') AS num_view
FROM events GROUP BY user_id""")
def p11(ctx: Context) -> DataFrame:
    return project.pivot_counts(ctx.table("events"), ["user_id"], "event_type", "num_", EVENT_TYPES)


# The event types that have a column of their own.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("p11_count_map", """
SELECT user_id, value_, n FROM (SELECT user_id, k AS value_, count(*) AS n FROM (SELECT user_id, CAST(CAST(value * 100 AS BIGINT) AS VARCHAR) AS k FROM events) GROUP BY ALL)""")
def p11_map(ctx: Context) -> DataFrame:
    """Counts for values nobody declared, many thousands of them, as one map a user; shown as its entries."""
    events = ctx.table("events").select("user_id", F.round(F.col("value") * 100).cast("bigint").cast("string").alias("cents"))
    return project.count_map(events, ["user_id"], "cents", "counts").select("user_id", F.explode("counts").alias("value_", "n"))


@query("p12_multivalue_flags", """
SELECT 'has_' || word AS flag, (SELECT count(*) FROM part) AS parts, count(DISTINCT p_partkey) AS parts_with
FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part) t GROUP BY word""")
def p12(ctx: Context) -> DataFrame:
    """Every word of a name is a flag of the part, however many words there are: counted in long form."""
    parts = ctx.table("part").select("p_partkey", "p_name")
    words = project.list_values(parts, ["p_partkey"], "p_name", " ", "word")
    return words.groupBy(F.concat(F.lit("has_"), "word").alias("flag")).agg(
        F.lit(parts.count()).alias("parts"), F.count_distinct("p_partkey").alias("parts_with"))


@query("p13_unknown_member", """
SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT -1, 'UNKNOWN', NULL""",
       ints="n_nationkey n_regionkey")
def p13(ctx: Context) -> DataFrame:
    return project.with_unknown(ctx.table("nation"), {"n_nationkey": -1, "n_name": "UNKNOWN"})


@query("p14_having", """
SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders GROUP BY o_custkey HAVING count(*) > 12 AND sum(CAST(o_totalprice AS DECIMAL(18,2))) > 2500000""")
def p14(ctx: Context) -> DataFrame:
    return (ctx.table("orders").groupBy("o_custkey")
            .agg(F.count(F.lit(1)).alias("orders"), F.sum(money(F.col("o_totalprice"))).alias("revenue"))
            .where("orders > 12 AND revenue > 2500000"))


# Which roles a masking policy lets see the data.
PRIVILEGED = {"personal_data": {"admin", "finance"}, "amounts": {"admin"}}


@query("p15_mask_pii", """
SELECT 'support' AS role, c_custkey, '**********' AS c_name, 0.0::DOUBLE AS c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT 'finance', c_custkey, c_name, 0.0::DOUBLE, c_mktsegment FROM customer
UNION ALL SELECT 'admin', c_custkey, c_name, c_acctbal, c_mktsegment FROM customer""")
def p15(ctx: Context) -> DataFrame:
    """The customer table as three roles see it."""
    people = ctx.table("customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    tags = {"c_name": "personal_data", "c_acctbal": "amounts"}
    return project.union_all([project.mask(people, tags, role, PRIVILEGED).withColumn("role", F.lit(role))
                              for role in ("support", "finance", "admin")])


@query("p16_seq_label", "SELECT r_regionkey, '(' || chr(97 + r_regionkey) || ') ' || r_name AS label FROM region",
       ints="r_regionkey")
def p16(ctx: Context) -> DataFrame:
    return ctx.table("region").select("r_regionkey", seq_label(F.col("r_regionkey"), F.col("r_name")).alias("label"))


@query("p17_pseudonymise", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN split_part(replace(c_name, '#', '@'), '@', 1)
       ELSE c_custkey || '@example.com' END AS handle
FROM customer""")
def p17(ctx: Context) -> DataFrame:
    login = F.replace(F.col("c_name"), F.lit("#"), F.lit("@"))
    return ctx.table("customer").select("c_custkey", pseudonymise(
        F.col("c_custkey"), login, F.col("c_mktsegment") == "BUILDING", "example.com").alias("handle"))


@query("u01_union_all", """
SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier""")
def u01(ctx: Context) -> DataFrame:
    a = ctx.table("customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"),
                                     F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = ctx.table("supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"),
                                     F.col("s_name").alias("name"))
    return project.union_all([a, b])


@query("u02_union_distinct", "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier",
       ints="nationkey")
def u02(ctx: Context) -> DataFrame:
    return (ctx.table("customer").select(F.col("c_nationkey").alias("nationkey"))
            .union(ctx.table("supplier").select("s_nationkey")).distinct())


@query("u03_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def u03(ctx: Context) -> DataFrame:
    return ctx.table("orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("u04_order_by", """
SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, o_orderstatus AS status, count(*) AS orders
FROM orders GROUP BY ALL ORDER BY year, month DESC, status""", ints="year month")
def u04(ctx: Context) -> DataFrame:
    out = ctx.table("orders").groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
                                      F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("orders"))
    return out.orderBy(F.col("year").asc_nulls_last(), F.col("month").desc_nulls_last(), F.col("status").asc_nulls_last())
