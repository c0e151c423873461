"""Invoices, receipts, payroll, bookings and the marts on money."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import day, month_first
from ledgerloom.functions.logic import classify, decode, money
from ledgerloom.functions.nested import json_path
from ledgerloom.functions.text import empty_to_null, regex_full, typed
from ledgerloom.models.warehouse import Warehouse, model
from ledgerloom.operators import aggregate, costs, joins, revenue
from ledgerloom.operators.calendar import date_dim, with_holidays
from ledgerloom.operators.ordered import first_per_key
from ledgerloom.operators.project import lookup_labels, union_all

c = F.col

# ISO-8601 charge intervals in months, and document codes.
INTERVALS = {"P1Y": 12, "P0Y1M": 1, "P0Y3M": 3, "P0Y6M": 6}
INTERVAL_NAMES = {"P1Y": "yearly", "P0Y1M": "monthly", "P0Y3M": "quarterly", "P0Y6M": "biannual"}
RECEIPT_STATUS = {"100": "Unpaid/Due", "1000": "Paid"}
RECURRENCE = {"VOU": "One-off", "RV": "Recurring"}
CONTACT_KINDS = {2: "Supplier", 3: "Customer", 4: "Partner"}


def _ref_id(column: str) -> Column:
    """Id out of a nested {"id": ..} reference."""
    return json_path(c(column), "id", "bigint")


@model("staging_invoices", "table")
def staging_invoices(wh: Warehouse) -> Iterator[DataFrame]:
    """Lines of real invoices (no drafts, no cancelled ones), set-united with the early invoices kept as receipts. No invoice is in two parts."""
    inv = wh.source("accounting", "invoices")
    cancelled = inv.where("invoice_type = 'SR'").select(_ref_id("origin").alias("cancelled_id")).where("cancelled_id IS NOT NULL")
    heads = inv.where((c("status").cast("int") != 100) & (c("invoice_type") == "RE")).select(
        typed(c("id"), "bigint").alias("invoice_id"), day(c("invoice_date")).alias("date_key"), "invoice_number", "header",
        typed(c("customer_note"), "bigint").alias("deal_id"), _ref_id("contact").alias("contact_id"), day(c("period_from")).alias("period_from"),
        day(c("period_to")).alias("period_to"), (c("status").cast("int") == 1000).alias("is_paid"), day(c("pay_date")).alias("pay_date"),
        decode(c("charge_interval"), INTERVALS).alias("charge_months"), "currency", c("days_to_pay").cast("int").alias("days_to_pay"),
        c("dunning_level").cast("int").alias("dunning_level"))
    heads = joins.null_aware_anti(heads, cancelled, "invoice_id", "cancelled_id")
    lines = wh.source("accounting", "invoice_items").select(
        _ref_id("invoice").alias("_inv"), typed(c("id"), "bigint").alias("line_id"), _ref_id("part").alias("product_id"), c("name").alias("product_name"),
        money(c("net")).alias("net_amount"), money(c("tax")).alias("tax_amount"), money(c("gross")).alias("gross_amount"), money(c("discount")).alias("discount"))
    parts = wh.source("accounting", "products").select(typed(c("id"), "bigint").alias("_part"), "part_number")
    kinds = wh.source("files", "revenue_categories").select(c("product_number").alias("_no"), c("is_recurring").cast("boolean").alias("is_recurring"), c("category").alias("revenue_category"))
    parts = parts.join(kinds, c("_no") == c("part_number"), "left").drop("_no")
    customers = wh.source("accounting", "customers").select(typed(c("id"), "bigint").alias("_cust"), typed(c("customer_number"), "bigint").alias("accounting_id"))
    early = wh.source("accounting", "receipts").where((c("credit_debit") == "D") & regex_full(c("description"), r"[0-9\.]+")
                                                      & (day(c("voucher_date")) <= F.lit("2021-01-01").cast("date"))).select(
        typed(c("id"), "bigint").alias("invoice_id"), day(c("voucher_date")).alias("date_key"), c("description").alias("invoice_number"),
        _ref_id("supplier").alias("contact_id"), money(c("net")).alias("_net"), money(c("tax")).alias("_tax"),
        money(c("gross")).alias("_gross"), (c("status") == "1000").alias("is_paid"), day(c("pay_date")).alias("pay_date"))
    for some, same in wh.in_passes(lines, "_inv", "invoice_lines"):
        known = same(heads, "invoice_id").join(customers, c("_cust") == c("contact_id"), "left").drop("_cust").withColumn("_early", F.lit(False))
        # early ones go through the join too, without lines: so the rows of an invoice are in one place and need no further shuffle to be united
        known = union_all([known, same(early, "invoice_id").withColumn("_early", F.lit(True))])
        some = some.join(parts, c("_part") == c("product_id"), "left").drop("_part")
        out = known.join(some, (c("_inv") == c("invoice_id")) & ~c("_early"), "left").drop("_inv")
        for n in ("net", "tax", "gross"):
            out = out.withColumn(f"{n}_amount", F.when(c("_early"), c(f"_{n}")).otherwise(c(f"{n}_amount"))).drop(f"_{n}")
        out = out.withColumn("due_date", F.date_add("date_key", c("days_to_pay"))).withColumn(
            "revenue_category", F.when(c("is_recurring"), "Monitoring recurring").otherwise(c("revenue_category")))
        yield out.drop("_early").distinct()


@model("staging_contacts", "table")
def staging_contacts(wh: Warehouse) -> DataFrame:
    """Accounting contacts with their preferred e-mail address."""
    ways = wh.source("accounting", "communication_way").where("type = 'EMAIL' AND value IS NOT NULL").select(
        _ref_id("contact").alias("contact_id"), c("value").alias("email"), json_path(c("key"), "id", "int").alias("_key"))
    counts = ways.groupBy("contact_id").agg(F.count_distinct("email").alias("num_emails"))
    best = first_per_key(ways, ["contact_id"], [c("_key").desc_nulls_last(), c("email")]).drop("_key").join(counts, "contact_id")
    rows = wh.source("accounting", "customers").where(~c("name").like("%Dummy%")).select(
        typed(c("id"), "bigint").alias("contact_id"), typed(c("customer_number"), "bigint").alias("customer_number"), c("name").alias("contact_name"),
        decode(_ref_id("category"), CONTACT_KINDS, "Unknown").alias("category"), F.replace(F.trim("bank_account"), F.lit(" "), F.lit("")).alias("iban"),
        c("bank_number").alias("bic"))
    return rows.join(best, "contact_id", "left")


@model("staging_receipts", "table")
def staging_receipts(wh: Warehouse) -> DataFrame:
    """Receipt lines with tags, categories and cost centres."""
    tags = F.transform(F.from_json("tags", "array<struct<name:string>>"), lambda t: t["name"])
    heads = wh.source("accounting", "receipts").where("status <> '50'").select(
        typed(c("id"), "bigint").alias("receipt_id"), day(c("voucher_date")).alias("date_key"), day(c("delivery_date")).alias("delivery_date"),
        day(c("pay_date")).alias("pay_date"), day(c("payment_deadline")).alias("due_date"), _ref_id("supplier").alias("contact_id"), "credit_debit",
        c("description"), empty_to_null(F.array_join(F.array_sort(tags), "; ")).alias("tags"), _ref_id("cost_centre").alias("cost_centre_id"),
        decode(c("status"), RECEIPT_STATUS).alias("payment_status"), decode(c("voucher_type"), RECURRENCE).alias("recurrence"),
        decode(c("recurring_interval"), INTERVAL_NAMES).alias("recurring_interval"))
    lines = wh.source("accounting", "receipt_items").select(
        _ref_id("voucher").alias("receipt_id"), typed(c("id"), "bigint").alias("line_id"), typed(c("tax_rate"), "double").alias("tax_percentage"),
        typed(c("net"), "decimal(10,2)").alias("net_amount"), typed(c("tax"), "decimal(10,2)").alias("tax_amount"),
        typed(c("gross"), "decimal(10,2)").alias("gross_amount"), c("comment").alias("line_description"), _ref_id("accounting_type").alias("account_id"))
    out = heads.join(lines, "receipt_id", "left")

    def labels(pairs: dict[int, str]) -> DataFrame:
        return wh.spark.createDataFrame(list(pairs.items()) or [(-1, "")], "code bigint, label string")
    out = lookup_labels(out, "account_id", labels(wh.rules.account_categories), "accounting_category", "other")
    return lookup_labels(out, "cost_centre_id", labels(wh.rules.cost_centres), "cost_centre", "UNKNOWN").drop("account_id")


@model("staging_payments")
def staging_payments(wh: Warehouse) -> DataFrame:
    return wh.source("accounting", "payments").select(
        typed(c("id"), "bigint").alias("payment_id"), day(c("value_date")).alias("date_key"), typed(c("amount"), "decimal(10,2)").alias("amount"),
        c("payee_name"), c("purpose"), decode(c("status"), {"100": "Created", "200": "Linked", "300": "Private", "400": "Booked"}).alias("payment_status"))


@model("staging_booked_revenue")
def staging_booked_revenue(wh: Warehouse) -> DataFrame:
    return wh.source("files", "revenue_booked").select(
        typed(c("date"), "date").alias("date_key"), F.replace("document", F.lit(" "), F.lit("")).alias("invoice_number"),
        typed(c("credit"), "decimal(18,2)").alias("credit"), typed(c("debit"), "decimal(18,2)").alias("debit"), c("account"))


@model("staging_ledgers_booked")
def staging_ledgers_booked(wh: Warehouse) -> DataFrame:
    number = "decimal(18,2)"
    return wh.source("files", "ledgers_booked").select(
        typed(c("date"), "date").alias("date_key"), c("report_category"), classify(c("ledger_name"), [("%salar%", "Personnel"), ("%rent%", "Rent"), ("%revenue%", "Revenue")],
                                                                                     "Other").alias("bi_category"),
        *[typed(c(n), number).alias(n) for n in ("amount_credit", "amount_debit", "end_balance_credit", "end_balance_debit")])


@model("fact_ledgers_booked")
def fact_ledgers_booked(wh: Warehouse) -> DataFrame:
    rows = wh.ref("staging_ledgers_booked").where("report_category IS NOT NULL")
    return aggregate.debit_credit(rows, ["report_category", "date_key", "bi_category"], ["amount_credit", "end_balance_credit"],
                                  ["amount_debit", "end_balance_debit"], ["booked_amount", "end_balance"])


@model("fact_targets")
def fact_targets(wh: Warehouse) -> DataFrame:
    return wh.source("files", "targets").select(typed(c("date"), "date").alias("date_key"), "department", "category",
                                                typed(c("target"), "decimal(18,2)").alias("target"))


@model("dim_date", "table")
def dim_date(wh: Warehouse) -> DataFrame:
    """Calendar from 2000 to eleven years ahead with holidays."""
    return with_holidays(date_dim(wh.spark, dt.date(2000, 1, 1), wh.as_of + dt.timedelta(days=4000)))


@model("dim_debtor_creditor")
def dim_debtor_creditor(wh: Warehouse) -> DataFrame:
    staff = wh.ref("staging_personnel_expenses").select(c("employee_name").alias("contact_name")).distinct()
    return wh.ref("staging_contacts").join(staff.withColumn("is_staff", F.lit(True)), "contact_name", "full").withColumn(
        "is_staff", F.coalesce("is_staff", F.lit(False)))


@model("fact_expenses_invoiced", "table")
def fact_expenses_invoiced(wh: Warehouse) -> DataFrame:
    """Payroll rows shaped as receipts and real receipts without the payroll contacts."""
    pay = wh.ref("staging_personnel_expenses")
    contact = wh.ref("staging_contacts").select(c("contact_name").alias("employee_name"), "contact_id")
    active = wh.ref("staging_employees").where("is_active").select("employee_name", c("department").alias("cost_centre"), "employee_id")
    staff = first_per_key(active, ["employee_name"], [c("employee_id")])
    total = (c("gross_salary") + c("social_security")).cast("decimal(18,2)")
    wages = pay.join(contact, "employee_name", "left").join(staff, "employee_name", "left").select(
        "date_key", total.alias("net_amount"), F.lit(0).cast("decimal(18,2)").alias("tax_amount"), total.alias("gross_amount"),
        F.concat(F.lit("SC - "), "employee_name").alias("line_description"), F.date_add("date_key", 28).alias("due_date"), c("date_key").alias("pay_date"),
        F.coalesce("contact_id", "employee_id").alias("contact_id"), F.lit("C").alias("credit_debit"),
        F.concat(F.date_format("date_key", "MM/yy"), F.lit("_salary")).alias("description"), "cost_centre",
        F.lit("Personnel expenses").alias("accounting_category"), F.lit("Paid").alias("payment_status"), F.lit("One-off").alias("recurrence"))
    hidden = wh.ref("staging_contacts").where(c("contact_name").isin(*wh.rules.payroll_contacts)).select("contact_id")
    receipts = wh.ref("staging_receipts").join(hidden, "contact_id", "left_anti")
    for n in ("net_amount", "tax_amount", "gross_amount"):
        receipts = receipts.withColumn(n, c(n).cast("decimal(18,2)"))
    return union_all([wages, receipts.drop("cost_centre_id")])


def _deal_keys(wh: Warehouse) -> DataFrame:
    return wh.ref("dim_deal").where("is_active AND deal_id <> -1").select(
        "deal_id", "deal_sk", c("company_sk").alias("company_id"), c("payment_months").alias("months"), "contract_start", "contract_end")


@model("fact_revenue_invoiced", "table")
def fact_revenue_invoiced(wh: Warehouse) -> Iterator[DataFrame]:
    """One row per invoice with recurring and other amounts."""
    companies = wh.ref("dim_company").where("accounting_id IS NOT NULL").select("accounting_id", c("company_sk").alias("company_id"))
    for invoices in wh.parts("staging_invoices"):
        lines = invoices.join(companies, "accounting_id", "left").select(
            "invoice_id", "deal_id", "company_id", c("date_key").alias("invoice_date"), c("charge_months").alias("months"),
            F.coalesce("is_recurring", F.lit(False)).alias("is_recurring"), c("net_amount").alias("net"))
        sums = revenue.invoiced_revenue(lines, _deal_keys(wh))
        heads = invoices.groupBy("invoice_id").agg(
            F.max("invoice_number").alias("invoice_number"), F.max("period_from").alias("period_from"), F.max("period_to").alias("period_to"),
            F.bool_or("is_paid").alias("is_paid"), F.max("due_date").alias("due_date"), F.max("dunning_level").alias("dunning_level"))
        ends = _deal_keys(wh).select("deal_sk", "contract_start", "contract_end")
        yield sums.join(heads, "invoice_id").join(ends, "deal_sk", "left")


@model("fact_revenue_booked")
def fact_revenue_booked(wh: Warehouse) -> DataFrame:
    return wh.ref("staging_booked_revenue")


@model("fact_revenue")
def fact_revenue(wh: Warehouse) -> DataFrame:
    """Invoiced against booked by invoice number."""
    lines = wh.ref("staging_invoices").select("invoice_number", c("net_amount").alias("net"), "discount")
    both = revenue.reconcile(lines, wh.ref("staging_booked_revenue"), "invoice_number")
    booked = wh.ref("staging_booked_revenue").groupBy("invoice_number").agg(F.max("date_key").alias("_booked"))
    heads = wh.ref("fact_revenue_invoiced").groupBy("invoice_number").agg(
        F.max("deal_sk").alias("deal_sk"), F.max("company_sk").alias("company_sk"), F.bool_or("is_paid").alias("is_paid"), F.max("invoice_date").alias("date_key"))
    dated = both.join(heads, "invoice_number", "left").join(booked, "invoice_number", "left")
    return dated.withColumn("date_key", F.coalesce("date_key", "_booked")).drop("_booked").withColumn("company_sk", F.coalesce("company_sk", F.lit(-1)))


@model("mart_invoicing")
def mart_invoicing(wh: Warehouse) -> DataFrame:
    """Expected invoices of running won contracts."""
    deals = wh.ref("dim_deal").where("is_won AND is_active")
    homes = wh.ref("dim_company").select("company_sk", (F.coalesce("country", F.lit("")) == wh.rules.domestic_country).alias("is_domestic"))
    contracts = deals.join(homes, "company_sk", "left").select(
        c("deal_sk").alias("deal_id"), c("contract_start").alias("start_date"), c("contract_end").alias("end_date"), c("payment_months").alias("k"),
        c("annual_recurring_revenue").cast("double").alias("arr"), "is_domestic")
    invoices = wh.ref("fact_revenue").where("invoice_revenue > 0 AND deal_sk > 0").select(c("deal_sk").alias("deal_id"), c("date_key").alias("invoice_date"), "is_paid")
    return revenue.next_invoices(contracts, invoices, wh.today).withColumnRenamed("deal_id", "deal_sk")


@model("mart_revenue_contracted")
def mart_revenue_contracted(wh: Warehouse) -> DataFrame:
    names = wh.ref("mart_deal_active").select("deal_sk", "deal_name", "payment_schema")
    rows = wh.ref("mart_invoicing").join(names, "deal_sk", "left").select(
        "date_key", money(c("gross_amount")).alias("gross"), money(c("net_amount")).alias("net"), "deal_name", "is_big", "payment_schema")
    return revenue.monthly_contracted(rows, [wh.as_of.year - 1, wh.as_of.year, wh.as_of.year + 1])


@model("mart_revenue_recurring")
def mart_revenue_recurring(wh: Warehouse) -> DataFrame:
    return revenue.recurring_invoiced(wh.ref("fact_revenue_invoiced").where("period_from IS NOT NULL AND period_to IS NOT NULL"))


@model("mart_overdue")
def mart_overdue(wh: Warehouse) -> DataFrame:
    names = wh.ref("dim_company").select("company_sk", c("company_name").alias("company"))
    rows = wh.ref("fact_revenue_invoiced").join(names, "company_sk", "left").select(
        "invoice_id", "company", c("total_amount").alias("net"), "due_date", "is_paid", c("dunning_level").alias("dunning"))
    return revenue.overdue(rows, wh.today)


@model("mart_direct_debit")
def mart_direct_debit(wh: Warehouse) -> DataFrame:
    """Open direct debits in cents with mandate data."""
    deals = wh.ref("staging_deals").where("is_active AND payment_type = 'SEPA payment'").select("deal_id", "iban", "account_holder", c("close_date").alias("mandate_date"))
    numbers = wh.ref("staging_contacts").select("contact_id", (c("customer_number") + 1000000).alias("customer_number"))
    rows = wh.ref("staging_invoices").where("NOT is_paid AND currency = 'EUR'").join(deals, "deal_id").join(numbers, "contact_id", "left")
    return rows.groupBy(c("date_key").alias("invoice_date"), "invoice_number", "header", "due_date", "iban", "mandate_date", "account_holder",
                        "customer_number").agg(revenue.cents(c("gross_amount")).alias("amount_cents"))


@model("mart_transfer")
def mart_transfer(wh: Warehouse) -> DataFrame:
    """Open one-off transfers in cents with bank data."""
    rows = wh.ref("fact_expenses_invoiced").where((c("payment_status") == "Unpaid/Due") & c("line_description").like("SC - %") & (c("recurrence") == "One-off"))
    sums = rows.groupBy("description", "contact_id", "receipt_id", "date_key", "due_date").agg(revenue.cents(c("gross_amount")).alias("amount_cents"))
    return sums.join(wh.ref("dim_debtor_creditor").select("contact_id", "contact_name", "iban", "bic", "customer_number"), "contact_id", "left")


@model("mart_customer_margin", "table")
def mart_customer_margin(wh: Warehouse) -> DataFrame:
    """Revenue, direct cost and allocated indirect cost per company and month."""
    month = month_first(c("invoice_date")).alias("month")
    income = wh.ref("fact_revenue_invoiced").where("is_paid").groupBy("company_sk", month).agg(
        F.sum("recurring_amount").alias("recurring_revenue"), F.sum("non_recurring_amount").alias("nonrecurring_revenue"))
    work = wh.ref("mart_customer_costs").groupBy(c("company_id").alias("company_sk"), month_first(c("day")).alias("month")).agg(
        F.sum(money(c("cost_total"))).alias("_staff"))
    usage = wh.ref("fact_site_ingestions").groupBy("company_sk", month_first(c("day")).alias("month")).agg(
        F.sum(money(c("seconds"), 3)).alias("seconds"), F.sum(money(c("data_size"), 6)).alias("data_size"))
    cloud = wh.ref("fact_cloud_costs").select("month", c("processing").cast("double").alias("processing"), c("storage").cast("double").alias("storage"))
    used = costs.allocate_by_usage(usage, cloud, ["month"], {"processing": ("seconds", "seconds"), "storage": ("data_size", "data_size")})
    direct = work.join(used.select("company_sk", "month", "direct_total"), ["company_sk", "month"], "full").select(
        "company_sk", "month", (-F.col("_staff").cast("double")).alias("direct_staff"), (-F.col("direct_total")).alias("direct_cloud"))
    direct = direct.withColumns({n: F.when(c("company_sk") == -1, F.lit(0.0)).otherwise(c(n)) for n in ("direct_staff", "direct_cloud")})
    sign = F.when(c("credit_debit") == "D", 1).otherwise(-1)
    staff = c("accounting_category") == "Personnel expenses"
    pools = wh.ref("fact_expenses_invoiced").groupBy(month_first(c("date_key")).alias("month")).agg(
        F.sum(F.when(staff, -c("gross_amount")).otherwise(0)).cast("double").alias("pool_staff"),
        F.sum(F.when(~staff, c("gross_amount") * sign).otherwise(0)).cast("double").alias("pool_misc"))
    active = wh.ref("dim_company").where("company_start IS NOT NULL").select(
        "company_sk", F.lit(True).alias("everyone"), F.coalesce("actual_sites", F.lit(0)).alias("sites"), "company_start",
        F.least(F.coalesce("company_end", wh.today), wh.today).alias("_until"))
    members = joins.expand_months(active, "company_start", "_until").drop("company_start", "_until")
    shared = costs.allocate(members, pools, ["month"], {"pool_staff": ("everyone", "sites"), "pool_misc": ("everyone", "sites")})
    shared = shared.select("company_sk", "month", c("allocated_pool_staff").alias("indirect_staff"), c("allocated_pool_misc").alias("indirect_misc"))
    return costs.customer_margin(income, direct, shared, ["company_sk", "month"], ["recurring_revenue", "nonrecurring_revenue"],
                                 ["direct_staff", "direct_cloud", "indirect_staff", "indirect_misc"])
