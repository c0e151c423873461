"""Queries for joins (D)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.context import Context
from ledgerloom.functions.nested import associations
from ledgerloom.functions.text import norm_name
from ledgerloom.operators import joins
from ledgerloom.operators.identity import merged_entities, resolve_identities
from ledgerloom.operators.project import dense_grid
from ledgerloom.plans.registry import query
from ledgerloom.plans.shapes import CONTRACT, POLY, RATE_HIST, SITE, STAGE_HIST, contract, poly, rate_hist, site, stage_hist

c = F.col


@query("d01_inner_equi", """
SELECT o_orderkey, c_name, c_mktsegment, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey""")
def d01(ctx: Context) -> DataFrame:
    return (ctx.table("orders").join(ctx.table("customer"), c("o_custkey") == c("c_custkey"))
            .select("o_orderkey", "c_name", "c_mktsegment", "o_totalprice"))


@query("d02_left_equi", """
SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F'""")
def d02(ctx: Context) -> DataFrame:
    on = (c("o_custkey") == c("c_custkey")) & (c("o_orderstatus") == "F")
    return ctx.table("customer").join(ctx.table("orders"), on, "left").select("c_custkey", "o_orderkey", "o_totalprice")


@query("d03_full_outer_merge", """
WITH a AS (SELECT c_nationkey AS nation, c_custkey % 2 AS half, count(*) AS customers FROM customer WHERE c_acctbal > 8000 GROUP BY ALL),
     b AS (SELECT s_nationkey AS nation, s_suppkey % 2 AS half, count(*) AS suppliers FROM supplier GROUP BY ALL)
SELECT coalesce(a.nation, b.nation) AS nation, coalesce(a.half, b.half) AS half, customers, suppliers
FROM a FULL JOIN b ON a.nation = b.nation AND a.half = b.half""", ints="nation")
def d03(ctx: Context) -> DataFrame:
    a = ctx.table("customer").where("c_acctbal > 8000").groupBy(
        c("c_nationkey").alias("nation"), (c("c_custkey") % 2).alias("half")).agg(F.count(F.lit(1)).alias("customers"))
    b = ctx.table("supplier").groupBy(c("s_nationkey").alias("nation"), (c("s_suppkey") % 2).alias("half")).agg(
        F.count(F.lit(1)).alias("suppliers"))
    return joins.full_merge(a, b, ["nation", "half"])


@query("d04_semi", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def d04(ctx: Context) -> DataFrame:
    return joins.semi(ctx.table("orders").select("o_orderkey", "o_custkey"), ctx.table("customer").where("c_acctbal < 0"),
                      "o_custkey", "c_custkey")


@query("d05_null_aware_anti", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)""")
def d05(ctx: Context) -> DataFrame:
    return joins.null_aware_anti(ctx.table("customer").select("c_custkey", "c_name"),
                                 ctx.table("orders").where("o_totalprice > 450000"), "c_custkey", "o_custkey")


@query("d06_scd2_point_in_time", f"""
WITH {RATE_HIST}
SELECT e.event_id, e.user_id, e.ts, r.n AS version, r.rate FROM events e
LEFT JOIN rate_hist r ON r.owner_id = e.user_id AND e.ts >= r.valid_from AND e.ts < r.valid_to""", text="ts", ints="version")
def d06(ctx: Context) -> DataFrame:
    facts = ctx.table("events").select("event_id", c("user_id").alias("owner_id"), "ts")
    out = joins.asof_scd2(facts, rate_hist(ctx), "owner_id", "ts", grain="week")
    return out.select("event_id", c("owner_id").alias("user_id"), "ts", c("n").alias("version"), "rate")


@query("d07_interval_between", f"""
WITH {RATE_HIST}
SELECT e.event_id, r.n AS version, r.rate FROM events e JOIN rate_hist r ON r.owner_id = e.user_id
 AND CAST(e.ts AS DATE) BETWEEN CAST(r.valid_from AS DATE) AND CAST(r.valid_to AS DATE)""", ints="version")
def d07(ctx: Context) -> DataFrame:
    """Inclusive ends: an event on the day two versions share matches both."""
    facts = ctx.table("events").select("event_id", c("user_id").alias("owner_id"), c("ts").cast("date").alias("day"))
    dim = rate_hist(ctx).withColumn("valid_from", c("valid_from").cast("date")).withColumn("valid_to", c("valid_to").cast("date"))
    out = joins.interval_join(facts, dim, "owner_id", "day", "valid_from", "valid_to", "inner", "both", grain="week")
    return out.select("event_id", c("n").alias("version"), "rate")


@query("d08_interval_overlap", f"""
WITH {STAGE_HIST}, {RATE_HIST}
SELECT s.event_id, s.stage, r.n AS version, greatest(s.valid_from, r.valid_from) AS overlap_from, least(s.valid_to, r.valid_to) AS overlap_to
FROM stage_hist s JOIN rate_hist r ON r.owner_id = s.entity_id AND s.valid_from < r.valid_to AND s.valid_to > r.valid_from""",
       text="overlap_from overlap_to", ints="version")
def d08(ctx: Context) -> DataFrame:
    a = stage_hist(ctx).select(c("entity_id").alias("owner_id"), "event_id", "stage", c("valid_from").alias("a_from"),
                               c("valid_to").alias("a_to"))
    b = rate_hist(ctx).select("owner_id", "n", c("valid_from").alias("b_from"), c("valid_to").alias("b_to"))
    # an overlap starts with a version of either side, so the two sets of starts bound it
    low, high = joins.time_span(ctx.table("events"), "ts")
    b_low, b_high = joins.time_span(b, "b_from")
    out = joins.overlap_join(a, b, "owner_id", "a_from", "a_to", "b_from", "b_to",
                             (min(low, b_low), max(high, b_high)), grain="week")
    return out.select("event_id", "stage", c("n").alias("version"), "overlap_from", "overlap_to")


@query("d09_spine_expand", f"""
WITH {CONTRACT}
SELECT * FROM (SELECT deal_id, start_date, CAST(unnest(generate_series(date_trunc('month', CAST(start_date AS TIMESTAMP)),
    CAST(end_date AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month FROM contract) t WHERE month >= start_date""", text="start_date month")
def d09(ctx: Context) -> DataFrame:
    return joins.expand_months(contract(ctx), "start_date", "end_date").select("deal_id", "start_date", "month")


@query("d10_point_in_polygon", f"""
WITH {SITE}, {POLY}
SELECT site_id, country_id FROM site JOIN poly ON lon >= min_lon AND lon < max_lon AND lat >= min_lat AND lat < max_lat""",
       ints="country_id")
def d10(ctx: Context) -> DataFrame:
    return joins.point_in_polygon(site(ctx), poly(ctx), "lon", "lat", "ring").select("site_id", "country_id")


@query("d11_fallback_match", f"""
WITH {SITE}, {POLY}, hit AS (
  SELECT site_id, country_id FROM site JOIN poly ON lon >= min_lon AND lon < max_lon AND lat >= min_lat AND lat < max_lat)
SELECT s.site_id, coalesce(h.country_id, n.n_nationkey, -1) AS country_id
FROM site s LEFT JOIN hit h ON h.site_id = s.site_id
LEFT JOIN nation n ON n.n_nationkey = s.nation_id AND n.n_regionkey < 3""", ints="country_id")
def d11(ctx: Context) -> DataFrame:
    """Area by position, else the stated country if its region is served, else -1."""
    sites = site(ctx)
    hits = joins.point_in_polygon(sites, poly(ctx), "lon", "lat", "ring").select(c("site_id").alias("k"), "country_id")
    stated = ctx.table("nation").where("n_regionkey < 3").select("n_nationkey", c("n_nationkey").alias("v"))
    out = joins.first_match(sites, [(c("site_id"), hits), (c("nation_id"), stated)], "country", -1)
    return out.select("site_id", c("country").alias("country_id"))


@query("d12_normalised_key", """
SELECT c_custkey, n_nationkey AS matched FROM customer JOIN nation ON lower(trim('  nation_' || c_nationkey)) = lower(trim(n_name))""",
       ints="matched")
def d12(ctx: Context) -> DataFrame:
    a = ctx.table("customer").select("c_custkey", F.concat(F.lit("  nation_"), c("c_nationkey").cast("string")).alias("typed"))
    return joins.norm_join(a, ctx.table("nation"), "typed", "n_name").select("c_custkey", c("n_nationkey").alias("matched"))


@query("d13_disjunctive_range", f"""
WITH {RATE_HIST}
SELECT e.event_id, r.n AS version FROM events e LEFT JOIN rate_hist r ON r.owner_id = e.user_id
 AND ((e.ts - to_days(3) >= r.valid_from AND e.ts - to_days(3) < r.valid_to) OR (e.ts - to_days(3) <= r.valid_from AND r.n = 0))""",
       ints="version")
def d13(ctx: Context) -> DataFrame:
    """Entries older than the first version belong to it as well (here: event times moved three days back)."""
    facts = ctx.table("events").select("event_id", c("user_id").alias("owner_id"),
                                       (c("ts") - F.expr("INTERVAL 3 DAYS")).alias("ts"))
    dim = rate_hist(ctx).withColumn("is_first", c("n") == 0)
    return joins.first_version_join(facts, dim, "owner_id", "ts", "valid_from", "valid_to", "is_first",
                                    grain="week").select("event_id", c("n").alias("version"))


@query("d14_full_outer_range", f"""
WITH {RATE_HIST}, late AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15')
SELECT coalesce(e.user_id, r.owner_id) AS owner_id, e.event_id, r.n AS version, r.rate
FROM late e FULL JOIN rate_hist r ON r.owner_id = e.user_id AND e.ts >= r.valid_from AND e.ts < r.valid_to""", ints="version")
def d14(ctx: Context) -> DataFrame:
    facts = ctx.table("events").where("ts >= TIMESTAMP_NTZ'2024-01-15'").select("event_id", c("user_id").alias("owner_id"), "ts")
    out = joins.full_interval_join(facts, rate_hist(ctx), "owner_id", "ts", "valid_from", "valid_to",
                                   ["owner_id", "valid_from"], grain="week")
    return out.select("owner_id", "event_id", c("n").alias("version"), "rate")


# The states an order can be in.
ORDER_STATUSES = ["F", "O", "P"]


@query("d15_cross", """
SELECT n_name, s.o_orderstatus AS status, count(o.o_orderkey) AS orders
FROM nation CROSS JOIN (SELECT DISTINCT o_orderstatus FROM orders) s
LEFT JOIN (SELECT o_orderkey, o_orderstatus, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey) o
  ON o.c_nationkey = n_nationkey AND o.o_orderstatus = s.o_orderstatus
GROUP BY n_name, s.o_orderstatus""")
def d15(ctx: Context) -> DataFrame:
    """Dense nation x status matrix with order counts; the short side is a constant array, not a join."""
    orders = ctx.table("orders")
    grid = dense_grid(ctx.table("nation").select("n_nationkey", "n_name"), "status", ORDER_STATUSES)
    counts = (orders.join(ctx.table("customer"), c("o_custkey") == c("c_custkey"))
              .groupBy(c("c_nationkey").alias("n_nationkey"), c("o_orderstatus").alias("status"))
              .agg(F.count(F.lit(1)).alias("n")))
    return grid.join(counts, ["n_nationkey", "status"], "left").select(
        "n_name", "status", F.coalesce("n", F.lit(0)).alias("orders"))


@query("d16_flatten_inner", """
SELECT o_orderkey AS event_id, o_custkey AS linked_id, 'company' AS kind FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, o_orderkey % 10, 'ticket' FROM orders WHERE o_totalprice > 200000""")
def d16(ctx: Context) -> DataFrame:
    """JSON arrays of {id, type}: one row per element, none for rows without elements."""
    def link(cond, ident, kind: str):
        return F.when(cond, F.struct(ident.cast("string").alias("id"), F.lit(kind).alias("type")))
    links = F.array(link(c("o_orderstatus") != "P", c("o_custkey"), "company"),
                    link(c("o_totalprice") > 200000, c("o_orderkey") % 10, "ticket"))
    raw = ctx.table("orders").select(c("o_orderkey").alias("event_id"), F.to_json(F.filter(links, lambda x: x.isNotNull())).alias("links"))
    arrays = raw.select("event_id", associations(c("links")).alias("links"))
    return joins.flatten(arrays, "links", "link").select(
        "event_id", c("link.id").cast("bigint").alias("linked_id"), c("link.type").alias("kind"))


@query("d17_flatten_outer", """
WITH d AS (SELECT c_custkey, unnest(CASE WHEN c_nationkey % 4 = 0 THEN [NULL] ELSE range(1, c_nationkey % 4 + 1) END) AS deal_id FROM customer),
k AS (SELECT c_custkey, unnest(CASE WHEN c_acctbal < 3000 THEN [NULL] ELSE [c_custkey * 2, c_custkey * 2 + 1] END) AS contact_id FROM customer)
SELECT d.c_custkey AS company_id, deal_id, contact_id FROM d JOIN k ON k.c_custkey = d.c_custkey""", ints="deal_id")
def d17(ctx: Context) -> DataFrame:
    """Two independent flattens keep the parent and multiply with each other."""
    n = c("c_nationkey") % 4
    parents = ctx.table("customer").select(
        c("c_custkey").alias("company_id"), F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).alias("deals"),
        F.when(c("c_acctbal") >= 3000, F.array(c("c_custkey") * 2, c("c_custkey") * 2 + 1)).alias("contacts"))
    return joins.flatten(joins.flatten(parents, "deals", "deal_id", outer=True), "contacts", "contact_id", outer=True)


@query("d18_sk_lookup", """
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(o_custkey + 1000, -1) AS company_sk FROM lineitem
LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON o_orderkey = l_orderkey""", ints="l_linenumber")
def d18(ctx: Context) -> DataFrame:
    dim = ctx.table("orders").where("o_orderstatus <> 'P'").select("o_orderkey", (c("o_custkey") + 1000).alias("company_sk"))
    lines = ctx.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.sk_lookup(lines, dim, "l_orderkey", "o_orderkey", "company_sk")


@query("d19_impute_join", """
WITH t AS (SELECT p_partkey, p_brand, CASE WHEN p_type <> 'PROMO' THEN p_size END AS size FROM part),
m AS (SELECT p_brand, round(CAST(sum(size) AS DOUBLE) / count(size), 1) AS mean FROM t WHERE size IS NOT NULL GROUP BY p_brand)
SELECT p_partkey, coalesce(CAST(size AS DOUBLE), mean) AS size FROM t LEFT JOIN m USING (p_brand)""")
def d19(ctx: Context) -> DataFrame:
    t = ctx.table("part").select("p_partkey", "p_brand", F.when(c("p_type") != "PROMO", c("p_size")).alias("raw"))
    return joins.impute_avg(t, ["p_brand"], "raw", "size", digits=1).select("p_partkey", "size")


@query("d20_entity_resolution", """
SELECT coalesce(a.id, b.id, o.id) AS id, coalesce(a.name, b.name, o.name) AS name, coalesce(a.nation, b.nation, o.nation) AS nation,
       a.id IS NOT NULL AS crm, b.id IS NOT NULL AS portal, o.id IS NOT NULL AS billing
FROM (SELECT c_custkey AS id, c_name AS name, CASE WHEN c_acctbal > 0 THEN c_nationkey END AS nation FROM customer WHERE c_mktsegment <> 'BUILDING') a
FULL JOIN (SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation FROM supplier) b ON a.id = b.id
FULL JOIN (SELECT o_custkey AS id, NULL AS name, min(CAST(o_orderkey % 25 AS INTEGER)) AS nation FROM orders GROUP BY o_custkey) o
  ON coalesce(a.id, b.id) = o.id""", ints="nation")
def d20(ctx: Context) -> DataFrame:
    """One company from three systems; attributes come from the most trusted one that knows them."""
    crm = ctx.table("customer").where("c_mktsegment <> 'BUILDING'").select(
        c("c_custkey").alias("id"), c("c_name").alias("name"), F.when(c("c_acctbal") > 0, c("c_nationkey")).alias("nation"))
    portal = ctx.table("supplier").select(c("s_suppkey").alias("id"), c("s_name").alias("name"), c("s_nationkey").alias("nation"))
    billing = ctx.table("orders").groupBy(c("o_custkey").alias("id")).agg(
        F.min((c("o_orderkey") % 25).cast("int")).alias("nation")).withColumn("name", F.lit(None).cast("string"))
    return joins.resolve([("crm", crm), ("portal", portal), ("billing", billing)], ["id"], ["name", "nation"])


_IDENTITIES = """rec AS (
  SELECT 1 AS ord, 'crm' AS system, c_custkey AS record_id, c_custkey AS crm_id, NULL::BIGINT AS portal_id, CASE WHEN c_custkey % 4 = 0 THEN 'm' || (c_custkey // 4 % 300) || '@c.org' END AS mail,
         'firm ' || (c_custkey % 900) AS name, CASE WHEN c_acctbal > 0 THEN c_nationkey END AS nation FROM customer WHERE c_mktsegment <> 'BUILDING'
  UNION ALL SELECT 2, 'portal', s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey * 2 END, s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'm' || s_suppkey || '@c.org' END,
         'firm ' || (s_suppkey * 3), s_nationkey FROM supplier
  UNION ALL SELECT 3, 'billing', o_custkey, NULL, CASE WHEN o_custkey % 6 = 0 THEN o_custkey // 6 END, CASE WHEN o_custkey % 7 = 0 THEN 'm' || (o_custkey % 300) || '@c.org' END,
         CASE WHEN o_custkey % 11 = 0 THEN '' ELSE 'firm ' || (o_custkey + 5) END, min(o_orderkey % 25) FROM orders GROUP BY o_custkey),
n AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY ord, record_id) AS node FROM rec),
vals AS (SELECT 'c' AS k, crm_id::VARCHAR AS v, node FROM n WHERE crm_id IS NOT NULL UNION ALL SELECT 'p', portal_id::VARCHAR, node FROM n WHERE portal_id IS NOT NULL
  UNION ALL SELECT 'm', mail, node FROM n WHERE mail IS NOT NULL),
e1 AS MATERIALIZED (SELECT DISTINCT a.node AS a, b.node AS b FROM vals a JOIN vals b USING (k, v)),
reach1 AS (SELECT a, b FROM e1 UNION SELECT r.a, e.b FROM reach1 r JOIN e1 e ON r.b = e.a),
ent AS MATERIALIZED (SELECT n.*, coalesce(m, node) AS ent FROM n LEFT JOIN (SELECT a, min(b) AS m FROM reach1 GROUP BY a) ON node = a),
es AS (SELECT DISTINCT ent, system FROM ent),
held AS (SELECT DISTINCT name, ent FROM ent WHERE trim(name) <> ''),
twice AS (SELECT DISTINCT name FROM (SELECT name, system FROM held JOIN es USING (ent) GROUP BY ALL HAVING count(*) > 1)),
e2 AS MATERIALIZED (SELECT DISTINCT a.ent AS a, b.ent AS b FROM held a JOIN held b USING (name) WHERE name NOT IN (SELECT name FROM twice)),
reach2 AS (SELECT a, b FROM e2 UNION SELECT r.a, e.b FROM reach2 r JOIN e2 e ON r.b = e.a),
named AS (SELECT a AS ent, min(b) AS root FROM reach2 GROUP BY a),
bad AS (SELECT DISTINCT root FROM (SELECT root, system FROM named JOIN es USING (ent) GROUP BY ALL HAVING count(*) > 1)),
res AS MATERIALIZED (SELECT ent.*, coalesce(CASE WHEN root NOT IN (SELECT root FROM bad) THEN root END, ent.ent) AS entity,
  trim(name) <> '' AND name IN (SELECT name FROM twice) AS ambiguous FROM ent LEFT JOIN named USING (ent)),
final AS (SELECT r.*, f.system AS entity_system, f.record_id AS entity_id FROM res r JOIN n f ON r.entity = f.node)"""


def _identities(ctx: Context) -> DataFrame:
    k, none = c("c_custkey"), F.lit(None)
    crm = ctx.table("customer").where("c_mktsegment <> 'BUILDING'").select(
        F.lit("crm").alias("system"), k.alias("record_id"), k.alias("crm_id"), none.cast("bigint").alias("portal_id"),
        F.when(k % 4 == 0, F.concat(F.lit("m"), (F.floor(k / 4) % 300).cast("string"), F.lit("@c.org"))).alias("mail"),
        F.concat(F.lit("Firm "), (k % 900).cast("string")).alias("name"), F.when(c("c_acctbal") > 0, c("c_nationkey")).cast("bigint").alias("nation"))
    s = c("s_suppkey")
    portal = ctx.table("supplier").select(
        F.lit("portal").alias("system"), s.alias("record_id"), F.when(s % 3 == 0, s * 2).alias("crm_id"), s.alias("portal_id"),
        F.when(s % 5 == 0, F.concat(F.lit(" M"), s.cast("string"), F.lit("@C.org "))).alias("mail"),
        F.concat(F.lit(" FIRM "), (s * 3).cast("string"), F.lit(" ")).alias("name"), c("s_nationkey").cast("bigint").alias("nation"))
    o = c("o_custkey")
    billing = ctx.table("orders").groupBy("o_custkey").agg(F.min(c("o_orderkey") % 25).cast("bigint").alias("nation")).select(
        F.lit("billing").alias("system"), o.alias("record_id"), none.cast("bigint").alias("crm_id"), F.when(o % 6 == 0, F.floor(o / 6)).cast("bigint").alias("portal_id"),
        F.when(o % 7 == 0, F.concat(F.lit("m"), (o % 300).cast("string"), F.lit("@c.org"))).alias("mail"),
        F.when(o % 11 == 0, F.lit("")).otherwise(F.concat(F.lit("firm "), (o + 5).cast("string"))).alias("name"), "nation")
    records = crm.unionByName(portal).unionByName(billing).withColumns({n: norm_name(c(n)) for n in ("mail", "name")})
    return resolve_identities(records, SYSTEMS, ["crm_id", "portal_id", "mail"], ["name"])


SYSTEMS = ["crm", "portal", "billing"]


@query("d20_identity_resolution", f"""
WITH RECURSIVE {_IDENTITIES}
SELECT system, record_id, entity_system, entity_id, ambiguous FROM final""")
def d20_identities(ctx: Context) -> DataFrame:
    """Records of three systems that mean one company: ids and e-mails link transitively, names where they are not ambiguous."""
    return _identities(ctx).select("system", "record_id", "entity_system", "entity_id", "ambiguous")


@query("d20_merged_entities", f"""
WITH RECURSIVE {_IDENTITIES}
SELECT entity_system, entity_id, arg_min(name, (ord, record_id)) AS name, arg_min(nation, (ord, record_id)) AS nation,
  min(record_id) FILTER (system = 'crm') AS crm_id, min(record_id) FILTER (system = 'portal') AS portal_id, min(record_id) FILTER (system = 'billing') AS billing_id,
  bool_or(system = 'crm') AS in_crm, bool_or(system = 'portal') AS in_portal, bool_or(system = 'billing') AS in_billing, count(*) AS n_records
FROM final GROUP BY entity_system, entity_id""", ints="nation n_records")
def d20_merged(ctx: Context) -> DataFrame:
    """One row per company with attributes from the most trusted system that knows them."""
    return merged_entities(_identities(ctx), SYSTEMS, ["name", "nation"])
