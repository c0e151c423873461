"""Queries for data checks (Q)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.context import Context
from ledgerloom.functions.logic import money
from ledgerloom.operators import quality
from ledgerloom.plans.registry import query
from ledgerloom.plans.shapes import STAGE_HIST, hot_entities, stage_hist

c = F.col


@query("q01_not_null", "SELECT p_partkey, p_brand FROM (SELECT *, nullif(p_type, 'PROMO') AS kind FROM part) t WHERE kind IS NULL")
def q01(ctx: Context) -> DataFrame:
    part = ctx.table("part").withColumn("kind", F.nullif(c("p_type"), F.lit("PROMO")))
    return quality.not_null(part, "kind").select("p_partkey", "p_brand")


@query("q02_unique", """
SELECT l_orderkey || '-' || l_linenumber AS key0, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1 HAVING count(*) > 1""")
def q02(ctx: Context) -> DataFrame:
    key = F.concat_ws("-", "l_orderkey", "l_linenumber")
    return quality.unique(ctx.table("lineitem"), key, where=c("l_returnflag") == "A")


@query("q03_row_count", "SELECT count(o_orderkey) AS row_count FROM orders HAVING count(o_orderkey) < 1000000000")
def q03(ctx: Context) -> DataFrame:
    return quality.row_count(ctx.table("orders"), "o_orderkey", 1_000_000_000)


@query("q04_valid_range", """
SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate AS valid_from, l_shipdate AS valid_to
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderdate > l_shipdate""", text="valid_from valid_to", ints="l_linenumber")
def q04(ctx: Context) -> DataFrame:
    rows = ctx.table("lineitem").join(ctx.table("orders"), c("o_orderkey") == c("l_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", c("o_orderdate").alias("valid_from"), c("l_shipdate").alias("valid_to"))
    return quality.valid_range(rows)


_GAPPY = f"""WITH {STAGE_HIST}, kept AS (SELECT * FROM stage_hist WHERE stage <> 'error'),
l AS (SELECT *, lag(valid_to) OVER (PARTITION BY entity_id ORDER BY valid_to, valid_from) AS previous_to FROM kept)"""


def _gappy(ctx: Context) -> DataFrame:
    return stage_hist(ctx).where("stage <> 'error'")


@query("q05_date_gap", f"""{_GAPPY}
SELECT event_id, entity_id, valid_from, previous_to, date_diff('day', CAST(previous_to AS DATE), CAST(valid_from AS DATE)) AS day_difference
FROM l WHERE CAST(valid_from AS DATE) <> CAST(previous_to AS DATE)""", text="valid_from previous_to")
def q05(ctx: Context) -> DataFrame:
    out = quality.date_gaps(_gappy(ctx), "entity_id", hot_entities(ctx))
    return out.select("event_id", "entity_id", "valid_from", "previous_to", "day_difference")


@query("q06_time_gap", f"""{_GAPPY}
SELECT event_id, entity_id, valid_from, previous_to, date_diff('minute', valid_from, previous_to) AS minute_difference
FROM l WHERE date_diff('minute', valid_from, previous_to) <> 0""", text="valid_from previous_to")
def q06(ctx: Context) -> DataFrame:
    out = quality.time_gaps(_gappy(ctx), "entity_id", hot_entities(ctx))
    return out.select("event_id", "entity_id", "valid_from", "previous_to", "minute_difference")


@query("q07_single_active", f"""
WITH {STAGE_HIST} SELECT entity_id, count(*) FILTER (WHERE valid_to >= TIMESTAMP '2024-01-30 12:00:00') AS active_versions
FROM stage_hist GROUP BY entity_id HAVING count(*) FILTER (WHERE valid_to >= TIMESTAMP '2024-01-30 12:00:00') <> 1""")
def q07(ctx: Context) -> DataFrame:
    """'Active' here means valid after noon of the last day, which some users satisfy twice."""
    return quality.single_active(stage_hist(ctx), "entity_id", c("valid_to") >= F.expr("TIMESTAMP_NTZ'2024-01-30 12:00:00'"))


@query("q08_pair_compare", "SELECT p_partkey, p_size FROM part WHERE NOT (p_retailprice >= p_size * 40.0)", ints="p_size")
def q08(ctx: Context) -> DataFrame:
    part = ctx.table("part").withColumn("floor", c("p_size") * 40.0)
    return quality.pair_gt(part, "p_retailprice", "floor", or_equal=True).select("p_partkey", "p_size")


@query("q09_sum_between", """
SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS total FROM lineitem WHERE l_linestatus = 'O' GROUP BY l_orderkey
HAVING NOT (sum(CAST(l_quantity AS DECIMAL(18,2))) > 5 AND sum(CAST(l_quantity AS DECIMAL(18,2))) < 100)""", num="total")
def q09(ctx: Context) -> DataFrame:
    return quality.sum_between(ctx.table("lineitem"), money(c("l_quantity")), 5, 100, ["l_orderkey"],
                               c("l_linestatus") == "O", strict=True)


@query("q10_length_between", "SELECT p_partkey, p_name FROM part WHERE NOT (length(p_name) BETWEEN 8 AND 10)")
def q10(ctx: Context) -> DataFrame:
    return quality.length_between(ctx.table("part"), "p_name", 8, 10).select("p_partkey", "p_name")


@query("q11_relationship", """
SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def q11(ctx: Context) -> DataFrame:
    return quality.relationship(ctx.table("customer").select("c_custkey"), "c_custkey",
                                ctx.table("orders").where("o_orderstatus = 'F'"), "o_custkey")


@query("q12_accepted_values", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')")
def q12(ctx: Context) -> DataFrame:
    return quality.accepted(ctx.table("orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]).select(
        "o_orderkey", "o_orderpriority")


@query("q13_expression", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT (l_discount + l_tax <= 0.15)""", ints="l_linenumber")
def q13(ctx: Context) -> DataFrame:
    return quality.expression_true(ctx.table("lineitem"), c("l_discount") + c("l_tax") <= 0.15).select(
        "l_orderkey", "l_linenumber", "l_partkey")


@query("q14_dup_by_name_join", "SELECT p_name, count(p_name) AS n FROM part WHERE p_size > 40 GROUP BY p_name HAVING count(p_name) > 1")
def q14(ctx: Context) -> DataFrame:
    return quality.dup_names(ctx.table("part").withColumn("over", c("p_size") - 40), "p_name", c("over"))


@query("q15_summary", """
SELECT 'status not null' AS "check", 'error' AS severity, count(*) FILTER (WHERE o_orderstatus IS NULL) AS failing, 'pass' AS verdict FROM orders
UNION ALL SELECT 'price range', 'warn', count(*) FILTER (WHERE o_totalprice > 300000), 'warn' FROM orders
UNION ALL SELECT 'known priority', 'error', count(*) FILTER (WHERE o_orderpriority <> '5-LOW'), 'fail' FROM orders""")
def q15(ctx: Context) -> DataFrame:
    """Verdict table over several checks with severities, from one scan."""
    return quality.row_summary(ctx.table("orders"), [
        quality.Rule("status not null", "o_orderstatus IS NULL"), quality.holds("price range", "o_totalprice <= 300000", "warn"),
        quality.Rule("known priority", "o_orderpriority <> '5-LOW'")])
