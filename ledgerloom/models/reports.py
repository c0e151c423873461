"""Stage histories, cohorts, subscriptions, daily snapshots and other reports on CRM history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import day, micros
from ledgerloom.functions.logic import money
from ledgerloom.functions.nested import associations, ids_of
from ledgerloom.functions.text import typed
from ledgerloom.models.warehouse import Warehouse, model
from ledgerloom.operators import crm as crm_ops
from ledgerloom.operators import history, people, revenue, sales
from ledgerloom.operators.aggregate import pivot_min
from ledgerloom.operators.ordered import first_per_key, hot_keys
from ledgerloom.operators.project import current

c = F.col

# Deal stages of the cohort report in the order they are passed, and how they end.
COHORT_STAGES = {"mql": "Marketing Qualified Lead", "sql": "Sales Qualified Lead", "dealmaking": "Dealmaking", "offer_sent": "Offer Sent",
                 "signed": "Won", "ended": "Contract Ended", "lost": "Lost"}
COHORT_WON, COHORT_LOST = ["signed", "ended"], ["lost"]
PASSED = ["stage_mql_at", "stage_sql_at", "stage_dealmaking_at", "stage_offer_sent_at", "stage_signed_at"]


@model("deal_stage_history", "table")
def deal_stage_history(wh: Warehouse) -> DataFrame:
    """Change log of the deal stage."""
    raw = wh.snapshot("deals").select(typed(c("id"), "bigint").alias("deal_id"), c("dealstage").alias("stage"), c("valid_from").cast("timestamp_ntz").alias("valid_from"))
    hot = hot_keys("deal_id", raw)
    return history.change_history(raw, "deal_id", "stage", "valid_from", ["valid_from"], hot)


@model("fact_deal_stage_progression", "table")
def fact_deal_stage_progression(wh: Warehouse) -> DataFrame:
    names = wh.ref("staging_stages").where("object_type = 'deals'").select("stage_id", "stage_name")
    return history.stage_progression(wh.ref("deal_stage_history"), names, "deal_id", "stage", "valid_from")


@model("fact_deals", "table")
def fact_deals(wh: Warehouse) -> DataFrame:
    """Current deals with the time of every stage, skipped stages filled in, and days between stages."""
    steps = wh.ref("fact_deal_stage_progression")
    wide = pivot_min(steps, ["deal_id"], "stage_name", "entered_at", {f"stage_{n}_at": s for n, s in COHORT_STAGES.items()})
    first = steps.groupBy("deal_id").agg(F.min("entered_at").alias("earliest"))
    size = F.when(c("amount") < 5000, "small").when(c("amount") < 50000, "medium").when(c("amount").isNotNull(), "large")
    deals = current(wh.ref("staging_deals")).select("deal_id", "company_id", "deal_name", "amount", c("create_date").alias("created_at"), size.alias("size_class"))
    started = F.expr("DATE'2021-07-23'")   # recording of stage changes began here
    out = deals.join(wide, "deal_id", "left").join(first, "deal_id", "left")
    return history.stage_durations(history.backfill_stages(out, PASSED, "created_at", "earliest", started), PASSED)


def _cohorts(wh: Warehouse, interval: str) -> DataFrame:
    deals = wh.ref("fact_deals").withColumnRenamed("deal_id", "id")
    low = deals.agg(F.trunc(F.min("created_at"), "year")).first()[0]
    return sales.with_open(sales.deal_cohorts(deals, list(COHORT_STAGES), COHORT_WON, COHORT_LOST, low, wh.as_of, interval))


@model("fact_deal_cohorts_monthly")
def fact_deal_cohorts_monthly(wh: Warehouse) -> DataFrame:
    return _cohorts(wh, "month")


@model("fact_deal_cohorts_weekly")
def fact_deal_cohorts_weekly(wh: Warehouse) -> DataFrame:
    return _cohorts(wh, "week")


@model("fact_daily_snapshot_deals")
def fact_daily_snapshot_deals(wh: Warehouse) -> DataFrame:
    return history.daily_snapshot(history.drop_zero_length(wh.ref("staging_deals")), "deal_id", wh.as_of)


@model("fact_daily_snapshot_tickets")
def fact_daily_snapshot_tickets(wh: Warehouse) -> DataFrame:
    return history.daily_snapshot(wh.ref("staging_tickets"), "ticket_id", wh.as_of)


@model("fact_subscriptions", "table")
def fact_subscriptions(wh: Warehouse) -> DataFrame:
    """Monthly amount of each deal's latest invoice with its contract dates and company."""
    inv = wh.ref("staging_invoices").where("deal_id IS NOT NULL")
    heads = inv.select("invoice_id", c("contact_id").alias("customer_id"), "deal_id", c("date_key").alias("invoice_date"), c("charge_months").alias("months")).distinct()
    items = inv.select("invoice_id", c("product_name").alias("name"), c("net_amount").alias("net"), "is_recurring")
    deals = wh.ref("staging_deals").select("deal_id", "contract_start", "contract_end", c("is_active").alias("is_current"), F.lit(False).alias("is_archived"))
    out = revenue.subscriptions(heads, items, deals, c("is_recurring"))
    owner = wh.ref("staging_deals").where("is_active").select("deal_id", "company_id")
    return out.where("contract_start IS NOT NULL").join(owner, "deal_id", "left")


@model("fact_recurring_revenue_daily", "table")
def fact_recurring_revenue_daily(wh: Warehouse) -> DataFrame:
    """Company x day revenue with the kind of change."""
    subs = wh.ref("fact_subscriptions").where("company_id IS NOT NULL AND contract_start <= DATE'%s'" % wh.as_of.isoformat()).select(
        "company_id", c("contract_start").alias("start_date"), c("contract_end").alias("end_date"), money(F.coalesce("monthly_amount", F.lit(0.0))).alias("monthly_amount"))
    return revenue.mrr_changes(revenue.revenue_levels(subs, wh.as_of), wh.as_of)


@model("fact_tickets")
def fact_tickets(wh: Warehouse) -> DataFrame:
    """Current tickets with resolution times in hours."""
    rows = wh.ref("staging_tickets").where("is_active")
    hours = (micros(c("first_reply_at")) - micros(c("created_at"))) / 3_600_000_000.0
    return rows.withColumn("hours_to_first_reply", hours).drop("valid_from", "valid_to", "is_active")


@model("ticket_associations")
def ticket_associations(wh: Warehouse) -> DataFrame:
    """Tickets and what they are linked to, in long form."""
    raw = first_per_key(wh.snapshot("tickets"), ["id"], [c("valid_from").desc()])
    arrays = raw.select(typed(c("id"), "bigint").alias("ticket_id"), ids_of(associations(c("companies"))).alias("companies"))
    return crm_ops.bridge(arrays, "ticket_id", {"company": "companies"})


@model("deals_with_several_companies")
def deals_with_several_companies(wh: Warehouse) -> DataFrame:
    links = wh.source("crm", "deals").select(typed(c("id"), "bigint").alias("deal_id"), F.explode(ids_of(associations(c("companies")))).alias("company_id"))
    return crm_ops.multi_parent(links, "deal_id", "company_id")


@model("data_quality_deals")
def data_quality_deals(wh: Warehouse) -> DataFrame:
    """Fields of current deals a data-quality board looks at."""
    return wh.ref("staging_deals").where("is_active").select(
        "deal_id", "deal_name", "owner_id", "company_id", "stage_id", "amount", "contract_start", "contract_end", "payment_period", "iban",
        c("company_id").isNull().alias("no_company"), (c("contract_end") < c("contract_start")).alias("bad_contract"))


@model("owner_activity")
def owner_activity(wh: Warehouse) -> DataFrame:
    """Owner versions with an activity flag: still known, and seen within 30 days before the version ended."""
    owners = wh.snapshot("owners").select(typed(c("id"), "bigint").alias("owner_id"), "email", c("valid_from").cast("timestamp_ntz").alias("valid_from"),
                                          c("valid_to").cast("timestamp_ntz").alias("valid_to"))
    events = wh.ref("staging_engagements").select("owner_id", "at")
    return history.activity_flag(owners, events, wh.ref("staging_owners").select("owner_id"), "owner_id", "at", 30, wh.today.cast("timestamp_ntz"))


@model("mart_acquisition_cost")
def mart_acquisition_cost(wh: Warehouse) -> DataFrame:
    """Hours and cost spent on a company before its first win."""
    events = wh.ref("fact_engagements").where("total_minutes IS NOT NULL").select(
        c("company_sk").alias("company_id"), c("owner_sk").alias("owner_id"), "at", c("total_minutes").cast("decimal(18,2)").alias("minutes"), "event_id").distinct()
    won = wh.ref("dim_deal").where("won_date IS NOT NULL AND NOT is_poc").select(c("company_sk").alias("company_id"), c("won_date").cast("timestamp_ntz").alias("won_at"))
    owners = wh.ref("dim_owner").where("gross_salary IS NOT NULL")
    wages = owners.select(c("owner_sk").alias("owner_id"), day(c("valid_from")).alias("paid_at"), people.hourly_rate(owners).alias("rate"))
    return sales.acquisition_cost(events.drop("event_id"), won, wages)
