"""Deals, stages, line items, companies, engagements, tickets and the marts on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import day, open_end
from ledgerloom.functions.logic import classify, decode, flag
from ledgerloom.functions.nested import associations, size0
from ledgerloom.functions.text import empty_to_null, norm_name, typed
from ledgerloom.models.warehouse import ROW_CHECKS, Warehouse, model
from ledgerloom.operators import crm as crm_ops
from ledgerloom.operators import history, joins, people, quality, revenue, sales
from ledgerloom.operators.calendar import date_dim, with_holidays, working_minutes
from ledgerloom.operators.identity import merged_entities, resolve_identities
from ledgerloom.operators.ordered import collapse_islands, first_per_key, hot_keys, with_first_last, with_totals
from ledgerloom.operators.project import current, lookup_labels, union_all, with_unknown
from ledgerloom.operators.ranks import row_number_keys, surrogate_rank
from ledgerloom.operators.schedule import outstanding
from ledgerloom.sources.build import build_table, drop_deleted

c = F.col

# Stage names by patterns in the stage label, first hit wins, and their order.
STAGE_LADDER = [("%archiv%", "Lost"), ("%mql%", "Marketing Qualified Lead"), ("%lukewarm%", "Marketing Qualified Lead"),
                ("%sql%", "Sales Qualified Lead"), ("%warm%", "Sales Qualified Lead"), ("%product seen%", "Dealmaking"),
                ("%hot%", "Dealmaking"), ("%offer expired%", "Offer Sent"), ("contract terminated", "Contract Ended"),
                ("%cold%", "Lost"), ("%backlog%", "Lost"), ("%lost%", "Lost")]
STAGE_ORDER = {"New Lead": 0, "Marketing Qualified Lead": 1, "Sales Qualified Lead": 2, "Dealmaking": 3, "Offer Sent": 4,
               "Won": 5, "Contract Ended": 6, "Lost": 7}
FUNNEL = ["Marketing Qualified Lead", "Sales Qualified Lead", "Dealmaking", "Offer Sent", "Won"]
EARLY_STAGES = ("Offer Sent", "Dealmaking", "Sales Qualified Lead")
PAYMENT_MONTHS = {"yearly": 12, "quarterly": 3, "monthly": 1, "biyearly": 6}
STAGE_ARRAY = "array<struct<id:string,label:string,displayOrder:int,metadata:struct<probability:double,isClosed:boolean>>>"


def _ends(df: DataFrame) -> DataFrame:
    return df.withColumn("valid_from", c("valid_from").cast("timestamp_ntz")).withColumn(
        "valid_to", F.coalesce(c("valid_to").cast("timestamp_ntz"), open_end()))


def _is_open(end: Column) -> Column:
    return F.year(end) == 9999


@model("staging_stages", "table")
def staging_stages(wh: Warehouse) -> DataFrame:
    """Stages of all pipelines, latest version of each, with reporting names."""
    flat = wh.snapshot("pipelines").withColumn("s", F.explode(F.from_json("stages", STAGE_ARRAY))).select(
        "object_type", c("id").alias("pipeline_id"), c("label").alias("pipeline_name"), "valid_to", c("s.id").alias("stage_id"),
        F.lower("s.label").alias("label"), c("s.displayOrder").alias("shown"), flag(c("s.metadata.probability") == 1).alias("is_won"),
        c("s.metadata.isClosed").alias("is_closed"))
    latest = first_per_key(flat, ["stage_id"], [F.coalesce(c("valid_to").cast("timestamp_ntz"), open_end()).desc(), c("pipeline_id")])
    of_deal = F.when(c("is_won"), "Won").otherwise(F.coalesce(classify(c("label"), STAGE_LADDER), c("label")))
    out = latest.withColumn("stage_name", F.initcap(F.when(c("object_type") == "deals", of_deal).otherwise(c("label"))))
    out = out.withColumn("shown", decode(c("stage_name"), STAGE_ORDER, c("shown")))
    out = with_totals(out, ["object_type", "stage_name"], F.max("shown").alias("display_order"))
    out = out.withColumn("is_closed", F.when(c("stage_name") == "Lost", True).otherwise(c("is_closed")))
    return surrogate_rank(out, ["object_type", "stage_name"], "stage_sk").select(
        "stage_sk", "object_type", "pipeline_id", "pipeline_name", "stage_id", "stage_name", "display_order", "is_won", "is_closed")


DEAL_STATE = ["owner_id", "company_id", "pipeline_id", "stage_id", "deal_name", "segment", "deal_type", "category", "is_poc", "lost_type",
              "create_date", "close_date", "contract_start", "contract_end", "automatic_renewal", "payment_type", "payment_period",
              "payment_schema", "is_lagging", "iban", "account_holder", "amount", "arr"]


@model("staging_deals", "table")
def staging_deals(wh: Warehouse) -> DataFrame:
    """Deal versions, one per change of anything reported; the latest company holds for the whole history."""
    raw = _ends(drop_deleted(wh.snapshot("deals"), wh.source("crm", "deals"), "id"))
    types = {"newbusiness": "New Business", "existingbusiness": "Existing Business"}
    lost = {"not our customer": "Disqualified Lead", "Signed with competitor": "Product", "Will use free portals": "Price", "Not reachable": "Timing"}
    poc = "PoC / Test"
    deals = raw.select(
        typed(c("id"), "bigint").alias("deal_id"), F.get(ids_in_order(c("companies")), F.lit(0)).alias("_company"), typed(c("owner_id"), "bigint").alias("owner_id"),
        c("pipeline").alias("pipeline_id"), c("dealstage").alias("stage_id"), c("dealname").alias("deal_name"), c("customer_segment").alias("segment"),
        decode(c("dealtype"), types).alias("deal_type"), F.when(c("deal_category") == poc, "POC").otherwise(c("deal_category")).alias("category"),
        flag((c("test_deal") == "true") | (c("deal_category") == poc)).alias("is_poc"), decode(c("lost_reason"), lost).alias("lost_type"),
        day(c("created_at")).alias("create_date"), typed(c("closedate"), "date").alias("close_date"), typed(c("contract_start_date"), "date").alias("contract_start"),
        typed(c("contract_end_date"), "date").alias("contract_end"), flag(c("automatic_renewal") == "true").alias("automatic_renewal"),
        c("payment_type"), empty_to_null(c("payment_period")).alias("payment_period"), empty_to_null(c("payment_schema")).alias("payment_schema"),
        flag(c("billing_mode") == "Lagging").alias("is_lagging"),
        F.when(F.length("iban") > 15, F.upper(F.replace("iban", F.lit(" "), F.lit("")))).alias("iban"), empty_to_null(c("account_holder")).alias("account_holder"),
        typed(c("amount"), "decimal(10,2)").alias("amount"), typed(c("arr"), "decimal(10,2)").alias("arr"), "valid_from", "valid_to")
    deals = with_first_last(deals, ["deal_id"], ["valid_from", "valid_to"], last={"company_id": "_company"})
    hot = hot_keys("deal_id", wh.snapshot("deals").select(typed(c("id"), "bigint").alias("deal_id")))   # deleted deals among them: only the layout depends on it
    out = collapse_islands(deals, ["deal_id"], DEAL_STATE, "valid_from", "valid_to", hot)
    return out.withColumn("is_active", _is_open(c("valid_to")))


def ids_in_order(text: Column) -> Column:
    """Ids of a JSON association array in the order they came."""
    return F.transform(associations(text), lambda a: a["id"].cast("bigint"))


@model("staging_line_items")
def staging_line_items(wh: Warehouse) -> DataFrame:
    """Line-item versions of the deals they are associated with."""
    links = wh.source("crm", "deals").select(typed(c("id"), "bigint").alias("deal_id"), F.get(ids_in_order(c("companies")), F.lit(0)).alias("company_id"),
                                             F.explode(ids_in_order(c("line_items"))).alias("line_item_id")).distinct()
    number = "decimal(10,2)"
    items = wh.snapshot("line_items").select(
        typed(c("id"), "bigint").alias("line_item_id"), typed(c("product_id"), "bigint").alias("product_id"), c("name").alias("line_item_name"),
        typed(c("quantity"), "double").alias("_q"), *[typed(c(n), number).alias(n) for n in ("price", "total_discount", "amount", "acv", "arr", "mrr", "tcv")],
        empty_to_null(c("billing_frequency")).alias("billing_frequency"), typed(c("billing_start"), "date").alias("billing_start"),
        typed(c("billing_end"), "date").alias("billing_end"), F.coalesce(day(c("valid_from")), F.lit("2001-01-01").cast("date")).alias("valid_from"),
        F.coalesce(day(c("valid_to")), F.lit("9999-12-31").cast("date")).alias("valid_to"))
    pairs = wh.spark.createDataFrame(list(wh.rules.product_categories.items()) or [(-1, "other")], "product bigint, label string")
    items = lookup_labels(items, "product_id", pairs, "category", "other").withColumn("quantity", F.round("_q").cast("bigint")).drop("_q")
    return items.join(links, "line_item_id")


@model("staging_companies")
def staging_companies(wh: Warehouse) -> DataFrame:
    """Current companies of the CRM that still exist there."""
    raw = current(drop_deleted(wh.snapshot("companies"), wh.source("crm", "companies"), "id"))
    number = c("accounting_id")
    number = F.when(F.left(number, F.lit(2)) == "10", F.substring(number, F.lit(3), F.length(number))).otherwise(number)
    return raw.select(typed(c("id"), "bigint").alias("company_id"), c("name").alias("company_name"), typed(number, "bigint").alias("accounting_id"),
                      c("country"), F.initcap("industry").alias("industry"), typed(c("mwp"), "decimal(10,5)").alias("mwp_current"))


@model("staging_owners")
def staging_owners(wh: Warehouse) -> DataFrame:
    raw = current(wh.snapshot("owners"))
    out = raw.select(typed(c("id"), "bigint").alias("owner_id"), "email", F.concat("first_name", F.lit(" "), "last_name").alias("employee_name"),
                     c("user_id"), F.get(F.from_json("teams", "array<struct<name:string>>"), F.lit(0))["name"].alias("team"))
    return out.where(c("employee_name").isNotNull())


@model("staging_products")
def staging_products(wh: Warehouse) -> DataFrame:
    return current(wh.snapshot("products")).select(typed(c("id"), "bigint").alias("product_id"), c("name").alias("product_name"),
                                                   typed(c("price"), "decimal(10,2)").alias("price"))


@model("staging_engagements", "table")
def staging_engagements(wh: Warehouse) -> DataFrame:
    """Engagements paired with the deals and companies they belong to, with their durations."""
    raw = wh.source("crm_activity", "engagements").where(~c("archived"))
    rows = raw.select(
        typed(c("id"), "bigint").alias("event_id"), associations(c("deals")).alias("deals"), associations(c("companies")).alias("companies"),
        F.get(ids_in_order(c("contacts")), F.lit(0)).alias("contact_id"), F.get(ids_in_order(c("tickets")), F.lit(0)).alias("ticket_id"),
        size0(associations(c("contacts"))).alias("num_contacts"), typed(c("owner_id"), "bigint").alias("owner_id"),
        c("at").cast("timestamp_ntz").alias("at"), c("kind"), c("task_status"), c("meeting_outcome"),
        ((F.unix_timestamp(c("meeting_end").cast("timestamp")) - F.unix_timestamp(c("meeting_start").cast("timestamp"))) / 60.0).alias("meeting_minutes"),
        c("call_disposition"), typed(c("call_ms"), "double").alias("call_ms"))
    rows = sales.engagement_duration(rows)
    pairs = joins.flatten(joins.flatten(rows, "deals", "d", outer=True), "companies", "k", outer=True)
    pairs = pairs.withColumn("deal_id", c("d.id").cast("bigint")).withColumn("company_id", c("k.id").cast("bigint")).drop("d", "k")
    if wh.rules.own_company_ids:
        pairs = pairs.where(c("company_id").isNull() | ~c("company_id").isin(*wh.rules.own_company_ids))
    own = wh.ref("staging_deals").where("is_active AND company_id IS NOT NULL").select("deal_id", "company_id")
    return crm_ops.pair_companies(pairs, own)


COMPANY_SYSTEMS = ["crm", "second", "first"]


@model("company_members", "table")
def company_members(wh: Warehouse) -> DataFrame:
    """The company that each company record of the CRM and of both portals belongs to: by the CRM's id, else by a name that is not
    ambiguous. The first portal knows its companies by name alone."""
    crm = wh.ref("staging_companies").select(F.lit("crm").alias("system"), c("company_id").cast("string").alias("record_id"), c("company_id").alias("crm_id"), "company_name")
    second = wh.ref("staging_portal_companies").select(F.lit("second").alias("system"), c("portal_company_id").cast("string").alias("record_id"),
                                                       c("crm_company_id").alias("crm_id"), "company_name")
    first = wh.ref("staging_first_portal").where("company_name IS NOT NULL").groupBy(norm_name(c("company_name")).alias("record_id")).agg(F.min("company_name").alias("company_name"))
    records = union_all([crm, second, first.withColumn("system", F.lit("first"))])
    return resolve_identities(records.withColumn("name_key", norm_name(c("company_name"))), COMPANY_SYSTEMS, ["crm_id"], ["name_key"])


@model("dim_company", "table")
def dim_company(wh: Warehouse) -> DataFrame:
    """One row per company of the CRM and both portals, with the span of its running deals' contracts, to the end of the last month,
    and its sites in each portal; -1 is the unknown company."""
    members, entity = wh.ref("company_members"), ["entity_system", "entity_id"]
    number = c("record_id").cast("bigint")
    merged = merged_entities(members, COMPANY_SYSTEMS, ["company_name"]).select(*entity, "company_name", c("in_crm").alias("crm"), c("in_second").alias("portal"))
    ids = members.where("system <> 'first'").groupBy(*entity).agg(
        F.min(F.when(c("system") == "crm", number)).alias("company_id"), F.min(F.when(c("system") == "second", number)).alias("portal_company_id"))
    second = wh.ref("staging_sites").groupBy(c("portal_company_id").cast("string").alias("record_id")).agg(F.count_distinct("site_id").alias("_second"))
    first = wh.ref("staging_first_portal").groupBy(norm_name(c("company_name")).alias("record_id")).agg(F.count("site_id").alias("_first"))
    counted = union_all([second.withColumn("system", F.lit("second")), first.withColumn("system", F.lit("first"))])
    sites = members.join(counted, ["system", "record_id"]).groupBy(*entity).agg(F.sum("_second").alias("actual_sites"), F.sum("_first").alias("actual_first_sites"))
    spans = wh.ref("staging_deals").where("is_active AND contract_start IS NOT NULL AND contract_end IS NOT NULL").groupBy("company_id").agg(
        F.min("contract_start").alias("company_start"), F.last_day(F.max("contract_end")).alias("company_end"))
    out = merged.join(ids, entity, "left").join(sites, entity, "left").join(wh.ref("staging_companies").drop("company_name"), "company_id", "left").join(spans, "company_id", "left")
    second_flag, first_flag = flag(c("actual_sites") > 0), flag(c("actual_first_sites") > 0)
    out = out.withColumns({"in_second": second_flag, "in_first": first_flag, "portals": empty_to_null(F.concat(
        F.when(second_flag, "second;").otherwise(""), F.when(first_flag, "first;").otherwise("")))})
    out = surrogate_rank(out, ["company_id", "portal_company_id", "company_name"], "company_sk")
    return with_unknown(out, {"company_sk": -1, "company_id": -1, "portal_company_id": -1, "company_name": "UNKNOWN", "crm": False, "portal": False,
                              "in_second": False, "in_first": False})


@model("portal_company_keys", "table")
def portal_company_keys(wh: Warehouse) -> DataFrame:
    """The company of every company record of the second portal; several records may mean one company."""
    keys = wh.ref("dim_company").where("company_sk <> -1").select("entity_system", "entity_id", "company_sk")
    return wh.ref("company_members").where("system = 'second'").join(keys, ["entity_system", "entity_id"]).select(
        c("record_id").cast("bigint").alias("portal_company_id"), "company_sk")


@model("dim_deal", "table")
def dim_deal(wh: Warehouse) -> DataFrame:
    """Deal x stage interval, with the current attributes and contract values of the deal."""
    stages = wh.ref("staging_stages")
    versions = wh.ref("staging_deals")
    hot = hot_keys("deal_id", versions)
    spans = collapse_islands(history.drop_zero_length(versions), ["deal_id"], ["stage_id"], "valid_from", "valid_to", hot)
    names = stages.where("object_type = 'deals'").select("stage_id", "stage_name", "is_won", "is_closed")
    spans = build_table(spans.join(names, "stage_id", "left"), "deal_spans")   # both numberings read their rows twice
    spans = row_number_keys(spans, ["deal_id", "valid_from"], "deal_stage_sk")
    spans = surrogate_rank(spans, ["deal_id"], "deal_sk")
    wins = versions.join(stages.where("is_won").select("stage_id"), "stage_id", "left_semi").groupBy("deal_id").agg(F.min("valid_from").alias("won_date"))
    now = versions.where("is_active").where(c("pipeline_id").isin(*wh.rules.deal_pipelines)).drop("stage_id", "valid_from", "valid_to", "is_active")
    items = wh.ref("staging_line_items").where(_is_open(c("valid_to"))).withColumn("is_recurring", c("billing_frequency").isNotNull())
    valued = revenue.deal_values(items, now, "amount").join(wins, "deal_id", "left")
    out = joins.sk_lookup(valued, wh.ref("dim_company").where("company_id IS NOT NULL"), "company_id", "company_id", "company_sk")
    owners = wh.ref("dim_owner").where("is_active AND owner_id IS NOT NULL").select("owner_id", "owner_sk").distinct()
    out = joins.sk_lookup(out, owners, "owner_id", "owner_id", "owner_sk").join(spans, "deal_id")
    out = out.withColumn("payment_months", decode(c("payment_period"), PAYMENT_MONTHS, 0)).withColumn("is_active", _is_open(c("valid_to")))
    out = out.withColumn("valid_from", day(c("valid_from"))).withColumn("valid_to", day(c("valid_to"))).withColumn("won_date", day(c("won_date")))
    return with_unknown(out, {"deal_id": -1, "deal_sk": -1, "deal_stage_sk": -1, "company_sk": -1, "owner_sk": -1, "deal_name": "UNKNOWN",
                              "valid_from": "2017-12-31", "valid_to": "9999-12-31", "is_active": True})


@model("mart_deal_active")
def mart_deal_active(wh: Warehouse) -> DataFrame:
    return current(wh.ref("dim_deal")).drop("is_active")


@model("mart_sale_funnel")
def mart_sale_funnel(wh: Warehouse) -> DataFrame:
    deals = wh.ref("dim_deal")
    hot = hot_keys("deal_sk", deals)
    return sales.funnel(deals, "deal_sk", "stage_name", FUNNEL, hot, order=["valid_from", "deal_stage_sk"])


@model("mart_kpi")
def mart_kpi(wh: Warehouse) -> DataFrame:
    """Weekly figures of stages entered and of engagements in running deals."""
    deals = wh.ref("dim_deal")
    hot = hot_keys("deal_sk", deals)
    value = deals.withColumn("value", c("annual_contract_value").cast("double"))
    staged = sales.stage_kpis(value, "deal_sk", "stage_name", "value", [*FUNNEL, "Contract Ended", "Lost"], hot,
                              order=["valid_from", "deal_stage_sk"])
    now = deals.where("is_active").select("deal_sk", F.col("stage_name").alias("final_stage"))
    events = wh.ref("fact_engagements").where(~c("kind").isin("TASK", "NOTE") & c("stage_name").isin(*EARLY_STAGES, "Lost", "Marketing Qualified Lead"))
    events = events.join(now, "deal_sk", "left")
    weekly = sales.engagement_kpis(events, "at", "event_id", "kind", c("final_stage").isin("Won", "Contract Ended"), c("stage_name").isin(*EARLY_STAGES))
    return staged.unionByName(weekly)


@model("fact_engagements")
def fact_engagements(wh: Warehouse) -> DataFrame:
    """Engagements of deals with the deal stage, ticket stage and owner version valid at their time. The company is the deal's, else the
    engagement's own, else unknown; an engagement of no deal running then is no fact."""
    out = wh.ref("staging_engagements")
    span = joins.time_span(out, "at")
    deals = wh.ref("dim_deal").where("deal_id <> -1").select("deal_id", "deal_sk", "deal_stage_sk", "stage_name", c("company_sk").alias("_company"),
                                                             c("valid_from").alias("_df"), c("valid_to").alias("_dt"))
    out = joins.interval_join(out, deals, "deal_id", "at", "_df", "_dt", "inner", span=span)
    tickets = wh.ref("dim_ticket").select("ticket_id", "ticket_sk", c("stage_name").alias("ticket_stage"), c("valid_from").alias("_tf"), c("valid_to").alias("_tt"))
    out = joins.interval_join(out, tickets, "ticket_id", "at", "_tf", "_tt", span=span)
    owners = wh.ref("dim_owner").where("owner_id IS NOT NULL").select("owner_id", "owner_sk", c("valid_from").alias("_of"), c("valid_to").alias("_ot"))
    out = joins.interval_join(out, owners, "owner_id", "at", "_of", "_ot", span=span)
    out = joins.sk_lookup(out, wh.ref("dim_company").where("company_id IS NOT NULL"), "company_id", "company_id", "company_sk")
    out = out.withColumn("company_sk", F.coalesce(F.nullif("_company", F.lit(-1)), "company_sk"))
    return out.withColumn("owner_sk", F.coalesce("owner_sk", F.lit(-1))).drop("_company", "_df", "_dt", "_tf", "_tt", "_of", "_ot")


@model("mart_future_contracts")
def mart_future_contracts(wh: Warehouse) -> DataFrame:
    """Paid and outstanding instalments of running won contracts."""
    deals = wh.ref("dim_deal").where("is_won AND is_active").where((c("contract_start") <= wh.today) & (c("contract_end") >= wh.today))
    rows = deals.select("deal_sk", "company_sk", "contract_start", "contract_end", "payment_period", "payment_months",
                        F.when(c("payment_months") > 0, c("annual_recurring_revenue")).otherwise(0).cast("double").alias("arr"),
                        c("one_off_value").cast("double").alias("one_off_value"))
    return outstanding(rows, "contract_start", "contract_end", "payment_months", "arr", "one_off_value", wh.today)


@model("fact_revenue_contracted", "table")
def fact_revenue_contracted(wh: Warehouse) -> DataFrame:
    items = wh.ref("staging_line_items").select("deal_id", "line_item_id", c("quantity").cast("double").alias("quantity"), "billing_start", "billing_end",
                                                c("valid_from").alias("item_from"), c("valid_to").alias("item_to"))
    deals = wh.ref("dim_deal").where("stage_name = 'Won'").select("deal_id", "deal_stage_sk", "contract_start", "contract_end",
                                                                  c("valid_from").alias("deal_from"), c("valid_to").alias("deal_to"))
    low, high = joins.time_span(items, "item_from")
    low2, high2 = joins.time_span(deals, "deal_from")
    return revenue.contracted_revenue(items, deals, wh.today, (min(low, low2), max(high, high2)), "year")


@model("staging_tickets", "table")
def staging_tickets(wh: Warehouse) -> DataFrame:
    """Ticket versions with stage entries rebuilt from the entered / time-in columns."""
    raw = _ends(drop_deleted(wh.snapshot("tickets"), wh.source("crm", "tickets"), "id")).withColumn("ticket_id", typed(c("id"), "bigint"))
    current_rows = first_per_key(raw, ["ticket_id"], [c("valid_from").desc()])
    entries = history.stage_entries(current_rows, "ticket_id", "date_entered_", "time_in_")
    base = raw.select("ticket_id", c("stage").alias("old_stage"), c("pipeline").alias("pipeline_id"), typed(c("owner_id"), "bigint").alias("owner_id"),
                      F.get(ids_in_order(c("companies")), F.lit(0)).alias("company_id"), F.get(ids_in_order(c("deals")), F.lit(0)).alias("deal_id"), c("subject").alias("ticket_name"),
                      c("created_at").cast("timestamp_ntz").alias("created_at"), c("closed_at").cast("timestamp_ntz").alias("closed_at"),
                      c("first_reply_at").cast("timestamp_ntz").alias("first_reply_at"), (typed(c("time_to_close"), "double") / 3600000).alias("hours_to_close"),
                      typed(c("solution_time"), "double").alias("hours_to_solution"), "valid_from", "valid_to")
    base = with_totals(base, ["ticket_id"], F.min("valid_from").alias("_first"))
    base = base.withColumn("is_first", c("valid_from") == c("_first")).drop("_first")
    out = history.merge_entries(base, entries, "ticket_id", "is_first", "month").withColumn("stage_id", F.coalesce("stage", "old_stage"))
    out = build_table(out, "ticket_entries")
    state = ["stage_id", "pipeline_id", "owner_id", "company_id", "deal_id", "ticket_name"]
    hot = hot_keys("ticket_id", out)
    spans = collapse_islands(out, ["ticket_id"], state, "valid_from", "valid_to", hot,
                             also=["created_at", "closed_at", "first_reply_at", "hours_to_close", "hours_to_solution"])
    return spans.withColumn("is_active", _is_open(c("valid_to")))


@model("dim_ticket", "table")
def dim_ticket(wh: Warehouse) -> DataFrame:
    """Ticket x interval of one stage name and owner, with the ticket's current attributes. The first interval starts when the ticket was
    created; the company is the running deal's, else the ticket's own."""
    tickets = wh.ref("staging_tickets")
    names = wh.ref("staging_stages").where("object_type = 'tickets'").select("stage_id", "stage_name", "is_closed", "pipeline_name")
    versions = tickets.join(names, "stage_id", "left")
    hot = hot_keys("ticket_id", tickets)
    spans = collapse_islands(versions.select("ticket_id", "stage_name", "is_closed", "owner_id", "valid_from", "valid_to"), ["ticket_id"], ["stage_name", "is_closed", "owner_id"],
                             "valid_from", "valid_to", hot, order=["valid_to", "valid_from"])
    spans = with_totals(spans, ["ticket_id"], F.min("valid_from").alias("_first"))
    now = first_per_key(versions.where("is_active").drop("stage_name", "is_closed", "owner_id", "valid_from", "valid_to", "is_active"), ["ticket_id"], [c("stage_id")])
    out = spans.join(now, "ticket_id", "left")
    out = out.withColumn("valid_from", F.when(c("valid_from") == c("_first"), F.coalesce("created_at", "valid_from")).otherwise(c("valid_from"))).drop("_first")
    out = build_table(out, "ticket_spans")   # both numberings read their rows twice
    out = row_number_keys(out, ["ticket_id", "valid_from", "valid_to"], "ticket_stage_sk")
    out = surrogate_rank(out, ["ticket_id"], "ticket_sk").withColumn("is_active", _is_open(c("valid_to")))
    deals = wh.ref("dim_deal").where("is_active AND deal_id <> -1").select("deal_id", "deal_sk", c("company_sk").alias("_company")).distinct()
    out = out.join(deals, "deal_id", "left").withColumn("deal_sk", F.coalesce("deal_sk", F.lit(-1)))
    out = joins.sk_lookup(out, wh.ref("dim_company").where("company_id IS NOT NULL"), "company_id", "company_id", "company_sk")
    out = out.withColumn("company_sk", F.coalesce(F.nullif("_company", F.lit(-1)), "company_sk")).drop("_company")
    owners = wh.ref("dim_owner").where("is_active AND owner_id IS NOT NULL").select("owner_id", "owner_sk").distinct()
    return joins.sk_lookup(out, owners, "owner_id", "owner_id", "owner_sk")


@model("mart_ticket_active")
def mart_ticket_active(wh: Warehouse) -> DataFrame:
    return wh.ref("dim_ticket").where("is_active").drop("valid_from", "valid_to", "is_active")


@model("mart_ticket_working_time")
def mart_ticket_working_time(wh: Warehouse) -> DataFrame:
    """Service hours until a ticket was solved and until its first reply."""
    hours = wh.rules.service_hours
    rows = wh.ref("dim_ticket").where(~c("stage_name").isin(*wh.rules.quiet_ticket_stages) & c("pipeline_name").isin(*hours))
    end = F.least("valid_to", wh.today.cast("timestamp_ntz"), F.coalesce("closed_at", wh.today.cast("timestamp_ntz")))
    def local(x: Column) -> Column:
        return F.convert_timezone(F.lit("UTC"), F.lit(wh.rules.tz), x)
    rows = rows.select("ticket_sk", "pipeline_name", local(c("valid_from")).alias("start"), local(end).alias("until"),
                       local(F.least(end, c("first_reply_at"))).alias("reply"))
    low, _ = joins.time_span(rows, "start")
    cal = with_holidays(date_dim(wh.spark, low, wh.as_of))
    opens, closes = (decode(c("pipeline_name"), {k: v[i] for k, v in hours.items()}) for i in (0, 1))
    out = working_minutes(rows, "start", {"m_work": c("until"), "m_reply": c("reply")}, opens, closes, cal)
    return out.groupBy("ticket_sk").agg((F.sum("m_work").cast("double") / 60).alias("working_time"),
                                        (F.sum("m_reply").cast("double") / 60).alias("time_first_reply"))


@model("mart_customer_costs", "table")
def mart_customer_costs(wh: Warehouse) -> DataFrame:
    """Hours and cost of tickets, engagements and sprint issues per company, owner and day. A ticket's solution time goes before its time to close."""
    rates = wh.ref("dim_owner").where("owner_id IS NOT NULL AND gross_salary IS NOT NULL")
    rates = rates.select(c("owner_sk").alias("owner_id"), people.hourly_rate(rates).alias("rate"), "valid_from", "valid_to")
    tickets = wh.ref("mart_ticket_active").select(c("company_sk").alias("company_id"), c("owner_sk").alias("owner_id"), day(c("created_at")).alias("day"),
                                                  (F.coalesce("hours_to_solution", "hours_to_close") * (1 if wh.rules.ticket_hours_as_minutes else 60)).cast("decimal(18,3)").alias("minutes"))
    shared = F.when(c("num_companies") == 0, c("total_minutes")).otherwise(c("total_minutes") / c("num_companies"))
    events = wh.ref("fact_engagements").where("total_minutes > 0").select(
        c("company_sk").alias("company_id"), c("owner_sk").alias("owner_id"), day(c("at")).alias("day"), "event_id",
        shared.cast("decimal(18,3)").alias("minutes")).distinct().drop("event_id")
    issues = wh.ref("fact_sprint_issues").select(c("company_sk").alias("company_id"), c("owner_sk").alias("owner_id"), c("resolution_date").alias("day"),
                                                 (c("time_hours") * 60).cast("decimal(18,3)").alias("minutes"))
    return people.service_costs({"Ticket": tickets, "Engagement": events, "Tech issues": issues}, rates, closed="left")


_ENDS = quality.holds("valid_from before valid_to", "valid_from <= valid_to")
ROW_CHECKS.update({
    "dim_company": [quality.is_set("company_sk"), quality.is_set("company_name"), quality.holds("contract span", "company_start <= company_end", "warn")],
    "dim_deal": [quality.is_set("deal_sk"), quality.is_set("deal_stage_sk"), quality.is_set("company_sk"), quality.is_set("owner_sk"), quality.is_set("valid_from"), quality.is_set("valid_to"), _ENDS],
    "dim_ticket": [quality.is_set("ticket_sk"), quality.is_set("ticket_stage_sk"), quality.is_set("deal_sk"), quality.is_set("company_sk"), _ENDS]})
