"""Recurring, contracted and invoiced revenue."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.context import spread
from ledgerloom.functions.keys import surrogate_md5
from ledgerloom.functions.logic import money
from ledgerloom.operators.aggregate import sum_if
from ledgerloom.operators.joins import expand_days, overlap_join
from ledgerloom.operators.ordered import (HotKeys, carry_forward, collapse_islands, dense_ranks, first_per_key, hot_keys, neighbours,
                                          running_sum, with_totals)
from ledgerloom.operators.schedule import schedule


def revenue_levels(subs: DataFrame, as_of: dt.date, key: str = "company_id", start: str = "start_date",
                   end: str = "end_date", amount: str = "monthly_amount") -> DataFrame:
    """Stretches of constant revenue per company, from its first start to its last end (open subscriptions:
    ``as_of``), both days included.

    A subscription adds its amount on its first day and takes it off on its (exclusive) last. Summing those
    steps gives the level after each change; nothing is written out day by day to get there."""
    span = subs.groupBy(key).agg(F.max(F.coalesce(F.col(end), F.lit(as_of))).alias("span_end"),
                                 F.min(start).alias("span_start"))
    value = F.col(amount).cast("decimal(18,2)")
    step = F.array(F.struct(F.col(start).alias("day"), value.alias("delta")),
                   F.struct(F.col(end).alias("day"), (-value).cast("decimal(18,2)").alias("delta")))
    forward = F.col(end).isNull() | (F.col(end) > F.col(start))
    steps = subs.where(forward).select(key, F.explode(step).alias("s")).select(key, "s.*").where("day IS NOT NULL")
    # a zero step opens the series and one on the day after its end closes it
    edge = F.array(F.col("span_start"), F.date_add("span_end", 1))
    edges = span.select(key, F.explode(edge).alias("day"), F.lit(0).cast("decimal(18,2)").alias("delta"))
    points = steps.unionByName(edges).groupBy(key, "day").agg(F.sum("delta").alias("delta"))
    hot = hot_keys(key, subs)
    out = running_sum(points, [key], ["day"], hot, "delta", "monthly_revenue")
    out = neighbours(out, [key], ["day"], hot, following={"_next": "day"}).where(F.col("_next").isNotNull())
    out = out.select(key, F.col("day").alias("level_from"), F.date_sub("_next", 1).alias("level_to"),
                     F.col("monthly_revenue").cast("decimal(18,2)").alias("monthly_revenue"))
    out = out.withColumn("is_active", F.col("monthly_revenue") > 0)
    return with_totals(out, [key], F.max("level_to").alias("span_end"),
                       F.min(F.when(F.col("is_active"), F.col("level_from"))).alias("first_active_date"),
                       F.max(F.when(F.col("is_active"), F.col("level_to"))).alias("last_active_date"))


def _daily(levels: DataFrame, key: str) -> DataFrame:
    out = expand_days(spread(levels, key, "level_from"), "level_from", "level_to", "date")
    for name, day in (("is_first_date", "first_active_date"), ("is_last_date", "last_active_date")):
        out = out.withColumn(name, F.coalesce(F.col("date") == F.col(day), F.lit(False)))
    return out.withColumn("date_customer_id", surrogate_md5(F.col(key), F.col("date")))


def mrr_daily(levels: DataFrame, key: str = "company_id") -> DataFrame:
    """Company x day revenue: the levels written out, without another shuffle."""
    return _daily(levels, key).drop("level_from", "level_to", "span_end")


def churn_rows(levels: DataFrame, as_of: dt.date, key: str = "company_id") -> DataFrame:
    """The zero row on the day after the last active day."""
    off = F.lit(False)
    last = levels.where(F.col("is_active") & (F.col("level_to") == F.col("last_active_date"))
                        & (F.col("last_active_date") < F.lit(as_of)))
    return last.select(key, F.date_add("last_active_date", 1).alias("date"),
                       F.lit(0).cast("decimal(18,2)").alias("monthly_revenue"), off.alias("is_active"), "first_active_date",
                       "last_active_date", off.alias("is_first_date"), off.alias("is_last_date"))


def mrr_changes(levels: DataFrame, as_of: dt.date, key: str = "company_id") -> DataFrame:
    """Each day as new, churn, reactivation, upgrade, downgrade or none.

    Only the first day of a level can differ from the day before, so the look back runs over levels. A churn
    day that lies within the series is part of it already; one after its end is appended as a level."""
    extra = levels.where(F.col("is_active") & (F.col("level_to") == F.col("span_end")) & (F.col("span_end") < F.lit(as_of)))
    extra = extra.withColumns({"level_from": F.date_add("span_end", 1), "level_to": F.date_add("span_end", 1),
                               "monthly_revenue": F.lit(0).cast("decimal(18,2)"), "is_active": F.lit(False)})
    hot = hot_keys(key, levels)
    out = neighbours(levels.unionByName(extra), [key], ["level_from"], hot,
                     previous={"_mrr": "monthly_revenue", "_active": "is_active"})
    out = _daily(out, key)
    begins = F.col("date") == F.col("level_from")
    zero = F.lit(0).cast("decimal(18,2)")
    out = out.withColumn("previous_day_mrr", F.when(begins, F.coalesce("_mrr", zero)).otherwise(F.col("monthly_revenue")))
    out = out.withColumn("previous_day_is_active", F.when(begins, F.coalesce("_active", F.lit(False))).otherwise(F.col("is_active")))
    change = F.col("monthly_revenue") - F.col("previous_day_mrr")
    was, now = F.col("previous_day_is_active"), F.col("is_active")
    return out.withColumn("mrr_change", change).withColumn(
        "change_category", F.when(F.col("is_first_date"), "new").when(~now & was, "churn")
        .when(now & ~was, "reactivation").when(change > 0, "upgrade").when(change < 0, "downgrade").otherwise("none")
    ).drop("_mrr", "_active", "level_from", "level_to", "span_end")


def subscriptions(invoices: DataFrame, items: DataFrame, deals: DataFrame, recurring: Column) -> DataFrame:
    """Monthly amount of each deal's latest invoice with the contract dates of the deal.

    invoices(invoice_id, customer_id, deal_id, invoice_date, months), items(invoice_id, name, net),
    deals(deal_id, contract_start, contract_end, is_current, is_archived)."""
    latest = first_per_key(invoices, ["customer_id", "deal_id"],
                           [F.col("invoice_date").desc_nulls_last(), F.col("invoice_id").desc_nulls_last()])
    sums = items.where(recurring).groupBy("invoice_id").agg(F.sum("net").alias("_net"))
    out = latest.join(sums, "invoice_id").join(deals.where("is_current AND NOT is_archived"), "deal_id")
    return out.withColumn("monthly_amount", F.when(F.col("months") > 0, F.col("_net").cast("double") / F.col("months"))).select(
        "deal_id", "customer_id", "invoice_id", "contract_start", "contract_end", "monthly_amount")


def deal_values(items: DataFrame, deals: DataFrame, amount: str) -> DataFrame:
    """Contract values per deal from its open line items; the manual amount stands in where there are none.

    items(deal_id, category, quantity, acv, arr, mrr, tcv, is_recurring), deals(deal_id, is_poc, <amount>).
    What counts as volume or single site depends on whether the deal is a proof of concept."""
    poc = deals.select("deal_id", "is_poc")
    rows = items.join(poc, "deal_id", "left")
    saas = ~F.coalesce(F.col("is_poc"), F.lit(False))
    def picked(kind: str) -> Column:
        return F.col("category") == F.when(saas, F.lit(kind + " saas")).otherwise(F.lit(kind + " setup"))
    sums = rows.groupBy("deal_id").agg(
        F.sum(F.when(picked("volume-based"), F.col("quantity"))).alias("_volume"),
        F.sum(F.when(picked("single-site"), F.col("quantity"))).alias("single_sites"),
        F.sum("acv").alias("_acv"), F.sum("arr").alias("annual_recurring_revenue"),
        F.sum("mrr").alias("monthly_recurring_revenue"),
        sum_if(~F.col("is_recurring"), F.col("acv")).alias("one_off_value"), F.sum("tcv").alias("total_contract_value"))
    out = deals.join(sums, "deal_id", "left")
    return (out.withColumn("volume_based_mwp", F.col("_volume").cast("double") / 1000)
            .withColumn("annual_contract_value", F.coalesce("_acv", amount)).drop("_volume", "_acv"))


def contracted_revenue(items: DataFrame, deals: DataFrame, as_of: Column, span: tuple[dt.date, dt.date],
                       grain: str = "month") -> DataFrame:
    """Line-item versions under won contracts.

    items(deal_id, line_item_id, quantity, billing_start, billing_end, item_from, item_to),
    deals(deal_id, deal_stage_sk, contract_start, contract_end, deal_from, deal_to), won versions only.
    The overlap is clipped to the billing and contract dates; gaps are closed by the next start."""
    won = deals.where("deal_to > contract_start AND deal_from < contract_end")
    m = overlap_join(items, won, "deal_id", "item_from", "item_to", "deal_from", "deal_to", span, grain)
    low, high = F.col("overlap_from"), F.col("overlap_to")
    m = m.withColumn("valid_from", F.when(low < F.col("billing_start"), F.col("billing_start"))
                     .when(low < F.col("contract_start"), F.col("contract_start")).otherwise(low))
    m = m.withColumn("valid_to", F.when(high > F.col("billing_end"), F.col("billing_end"))
                     .when(high > F.col("contract_end"), F.col("contract_end")).otherwise(high))
    m = m.where((F.col("valid_to") > F.col("contract_start")) & (F.col("valid_from") < F.col("contract_end"))
                & (F.col("billing_start").isNull() | (F.col("billing_start") < F.col("valid_to"))))
    g = m.groupBy("deal_id", "deal_stage_sk", "line_item_id", "quantity", "billing_start", "billing_end").agg(
        F.min("valid_from").alias("valid_from"), F.max("valid_to").alias("valid_to"))
    hot = hot_keys("deal_id", items, deals)
    g = neighbours(g, ["deal_id", "line_item_id"], ["valid_from", "deal_stage_sk"], hot,
                   previous={"lag_quantity": "quantity"}, following={"_next": "valid_from"})
    g = g.withColumn("valid_to", F.coalesce("_next", "valid_to")).drop("_next")
    return (g.withColumn("is_active", (as_of >= F.col("valid_from")) & (as_of < F.col("valid_to")))
            .withColumn("is_change", ~F.coalesce(F.col("quantity") == F.col("lag_quantity"), F.lit(False))))


def invoiced_revenue(lines: DataFrame, deals: DataFrame) -> DataFrame:
    """Invoice lines to invoices. lines(invoice_id, deal_id, company_id, invoice_date, months, is_recurring, net),
    deals(deal_id, deal_sk, company_id, months). The interval comes from the invoice, else the deal, else
    1 for recurring and 0 for other lines."""
    d = deals.select("deal_id", F.col("deal_sk").alias("_dsk"), F.col("company_id").alias("_dco"), F.col("months").alias("_dm"))
    rows = lines.join(d, "deal_id", "left")
    interval = F.coalesce(F.col("months"), F.col("_dm"), F.when(F.col("is_recurring"), 1).otherwise(0))
    return rows.groupBy(
        "invoice_id", "invoice_date", F.coalesce("_dsk", F.lit(-1)).alias("deal_sk"),
        F.coalesce(F.col("company_id"), F.col("_dco"), F.lit(-1)).alias("company_sk"), interval.alias("payment_interval")).agg(
        sum_if(F.col("is_recurring"), F.col("net")).alias("recurring_amount"),
        sum_if(~F.col("is_recurring"), F.col("net")).alias("non_recurring_amount"), F.sum("net").alias("total_amount"))


def reconcile(invoiced: DataFrame, booked: DataFrame, key: str) -> DataFrame:
    """Invoiced against booked by invoice number. Both sides are summed per number before they meet."""
    a = invoiced.groupBy(key).agg(F.sum("net").alias("invoice_revenue"), F.sum("discount").alias("total_discount"),
                                  F.count(F.lit(1)).alias("line_items"))
    b = booked.groupBy(key).agg(F.sum("credit").alias("booked_credit"), F.sum("debit").alias("booked_debit"))
    return a.join(b, key, "full")


def next_invoices(contracts: DataFrame, invoices: DataFrame, as_of: Column, vat: float = 0.19,
                  big: float = 750.0) -> DataFrame:
    """Expected invoices of running contracts with what is known about earlier ones.

    contracts(deal_id, start_date, end_date, k, arr, is_domestic), invoices(deal_id, invoice_date, is_paid).
    The last invoice before each date is carried along the deal's timeline, and 'all earlier ones paid' is
    read off the date of its first unpaid invoice: no date ever meets every invoice of its deal."""
    running = contracts.where((F.col("start_date") <= as_of) & (F.col("end_date") >= as_of))
    net = F.when(F.col("k") > 0, F.col("arr") / (F.lit(12.0) / F.col("k"))).otherwise(F.lit(0.0))
    due = schedule(running.withColumn("net_amount", net), "start_date", "end_date", "k", "date_key", align="month_start")
    due = due.groupBy("deal_id", "date_key").agg(F.max("net_amount").alias("net_amount"), F.max("is_domestic").alias("is_domestic"))
    marks = due.select("deal_id", F.col("date_key").alias("day"), F.lit(0).alias("_side"), F.lit(None).cast("date").alias("last_invoice_before"))
    past = invoices.select("deal_id", F.col("invoice_date").alias("day"), F.lit(1).alias("_side"),
                           F.col("invoice_date").alias("last_invoice_before")).distinct()
    hot = hot_keys("deal_id", invoices)
    line = carry_forward(marks.unionByName(past), ["deal_id"], ["day", "_side"], hot, ["last_invoice_before"])
    before = line.where("_side = 0").select("deal_id", F.col("day").alias("date_key"), "last_invoice_before")
    facts = invoices.groupBy("deal_id").agg(F.max("invoice_date").alias("last_invoice"),
                                            F.min(F.when(~F.col("is_paid"), F.col("invoice_date"))).alias("_unpaid"))
    out = due.join(before, ["deal_id", "date_key"], "left").join(facts, "deal_id", "left")
    paid = F.when(F.col("last_invoice_before").isNotNull(), F.coalesce(F.col("_unpaid") >= F.col("date_key"), F.lit(True)))
    gross = F.when(F.col("is_domestic"), F.col("net_amount") * (1 + vat)).otherwise(F.col("net_amount"))
    return (out.withColumn("gross_amount", gross).withColumn("paid_before", paid)
            .withColumn("is_big", F.col("net_amount") > big).drop("_unpaid", "is_domestic"))


def monthly_contracted(invoices: DataFrame, years: list[int]) -> DataFrame:
    """Year and month totals per big deal, all small ones as 'other'. invoices(date_key, gross, net, deal_name,
    is_big, payment_schema); credit-model contracts are left out, an unknown schema stays in."""
    kept = invoices.where((F.col("payment_schema") != "Credit model") | F.col("payment_schema").isNull())
    out = kept.groupBy(F.year("date_key").alias("year"), F.month("date_key").alias("month"),
                       F.when(F.col("is_big"), F.col("deal_name")).otherwise("other").alias("deal")).agg(
        F.round(F.sum("gross"), 0).alias("gross_amount"), F.sum("net").alias("net_amount"))
    return out.where(F.col("year").isin(*years)).orderBy(
        F.col("year").asc_nulls_last(), F.col("month").asc_nulls_last(), F.col("deal").asc_nulls_last())


def recurring_invoiced(invoices: DataFrame) -> DataFrame:
    """Invoices to stretches of constant monthly revenue per company.

    invoices(company_sk, deal_sk, period_from, period_to, contract_start, contract_end, payment_interval,
    recurring_amount). Periods widen to whole months; the first and last period of a deal take the contract's
    start and (later) end. Amounts are summed exactly per interval and only then divided."""
    inv = invoices.where("payment_interval <> 0 AND recurring_amount > 0")
    inv = inv.withColumn("_from", F.trunc("period_from", "month")).withColumn("_to", F.last_day("period_to"))
    hot = hot_keys("company_sk", inv)
    inv = dense_ranks(inv, ["deal_sk", "company_sk"], "_from", hot, "_rn", "_rn_desc")
    first, last = F.col("_rn") == 1, (F.col("_rn_desc") == 1) & (F.col("contract_end") > F.col("_to"))
    inv = inv.withColumn("valid_from", F.when(first, F.coalesce("contract_start", "_from")).otherwise(F.col("_from")))
    inv = inv.withColumn("valid_to", F.when(last, F.col("contract_end")).otherwise(F.col("_to")))
    def part(months: int) -> Column:
        return F.sum(F.when(F.col("payment_interval") == months, money(F.col("recurring_amount"))).otherwise(
            F.lit(0))).cast("double")
    g = inv.groupBy("company_sk", "valid_from", "valid_to").agg(
        part(1).alias("mrr_month"), part(3).alias("_q"), part(6).alias("_b"), part(12).alias("_a"))
    g = g.withColumn("mrr_quarter", F.col("_q") / 3 + F.col("mrr_month"))
    g = g.withColumn("mrr_biannual", F.col("_b") / 6 + F.col("mrr_quarter"))
    g = g.withColumn("mrr_annual", F.col("_a") / 12 + F.col("mrr_biannual"))
    g = _mrr_islands(g, hot)
    return (g.withColumn("total_quarter", F.col("mrr_quarter") * 3).withColumn("total_biannual", F.col("mrr_biannual") * 6)
            .withColumn("total_annual", F.col("mrr_annual") * 12))


def _mrr_islands(g: DataFrame, hot: HotKeys | None) -> DataFrame:
    """Islands of equal annual-normalised revenue, reported per distinct level of the other three."""
    return collapse_islands(g, ["company_sk"], ["mrr_annual"], "valid_from", "valid_to", hot,
                            also=["mrr_biannual", "mrr_quarter", "mrr_month"])


def overdue(invoices: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Unpaid invoices past due by more than ``days``; invoices(invoice_id, company, net, due_date, is_paid, dunning)."""
    late = invoices.where((F.col("due_date") < as_of) & ~F.col("is_paid"))
    out = late.groupBy("invoice_id", "company", "due_date", F.when(F.col("dunning") == 1, 2).alias("dunning_level")).agg(
        F.sum("net").alias("_net"))
    return (out.withColumn("net_amount", F.round("_net").cast("bigint"))
            .withColumn("days_overdue", F.date_diff(as_of, F.col("due_date"))).drop("_net")
            .where(F.col("days_overdue") > days))


def cents(amount: Column) -> Column:
    """Integer cents of a sum of exact amounts."""
    return F.round(F.sum(money(amount)) * 100).cast("bigint")

