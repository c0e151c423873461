"""Invoices are made in passes, and what one pass takes on disk is free again for the next."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from ledgerloom.context import checkpointed
from ledgerloom.models import Warehouse
from ledgerloom.models.warehouse import MODELS, PASS_ROWS, ROW_CHECKS
from ledgerloom.operators import quality
from ledgerloom.operators.project import union_all
from ledgerloom.sources.build import build_table

c = F.col


def _ref(k):
    return None if k is None else f'{{"id":"{k}"}}'


@pytest.fixture
def raw(spark):
    """Odd raw relations: repeated rows and keys, null keys, lines of no invoice, an early invoice equal to a plain one."""
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)
    head = "id string, invoice_type string, origin string, status string, invoice_date string, invoice_number string, header string, customer_note string, contact string, " \
           "period_from string, period_to string, pay_date string, charge_interval string, currency string, days_to_pay string, dunning_level string"
    invoices = [(str(k), "RE", None, "1000" if k % 2 else "200", "2020-05-01", f"RE-{k}", "Invoice", str(k % 3), _ref(k % 5), "2020-05-01", "2020-06-01", None,
                 "P1Y" if k % 4 == 0 else None, "EUR", "14", "1") for k in range(1, 25)]
    invoices += [invoices[2], invoices[5], ("90", "SR", _ref(7), "1000", *[None] * 12), ("91", "RE", None, "100", *[None] * 12),
                 ("40", "RE", None, "1000", "2020-05-01", "40", None, None, _ref(3), *[None] * 7)]
    lines = [(_ref(k % 30), str(k), _ref(k % 6) if k % 7 else None, "Line", float(k), 0.0, float(k), 0.0) for k in range(80)]
    lines += [*lines[:40], (None, "1", _ref(1), "Line", 1.0, 0.0, 1.0, 0.0)]
    receipts = [(str(k), "2020-05-01", str(k), _ref(3), "D", "1000", None, float(k), 0.0, float(k)) for k in (3, 3, 4, 41, 42)]
    receipts += [("40", "2020-05-01", "40", _ref(3), "D", "1000", None, None, None, None), (None, "2020-05-01", "1.5", None, "D", "100", None, 1.0, 0.0, 1.0)]
    tables = {
        "invoices": frame(invoices, head),
        "invoice_items": frame(lines, "invoice string, id string, part string, name string, net double, tax double, gross double, discount double"),
        "products": frame([("1", "A"), ("1", "A"), ("2", "B"), ("3", "C"), ("3", "A"), ("4", None)], "id string, part_number string"),
        "revenue_categories": frame([("A", True, "x"), ("A", True, "y"), ("B", False, "z"), (None, True, "n"), ("C", None, "w")], "product_number string, is_recurring boolean, category string"),
        "customers": frame([(str(k), str(k + 10)) for k in (0, 1, 2, 3, 3)] + [("3", "99")], "id string, customer_number string"),
        "receipts": frame(receipts, "id string, voucher_date string, description string, supplier string, credit_debit string, status string, pay_date string, net double, tax double, gross double")}
    return lambda group, table: tables[table]


@pytest.fixture
def many_passes(spark):
    spark.conf.set(PASS_ROWS, "30")
    yield
    spark.conf.unset(PASS_ROWS)


def _warehouse(spark, raw, **options):
    wh = Warehouse(spark, raw, {}, dt.date(2024, 2, 1), **options)
    wh._done["dim_company"] = spark.createDataFrame([(10, 1), (11, 2), (13, 3), (13, 3), (99, 4)], "accounting_id bigint, company_sk bigint")
    wh._done["dim_deal"] = spark.createDataFrame([(1, 5, 7, 3), (2, 6, 8, 12)], "deal_id bigint, deal_sk bigint, company_sk bigint, payment_months int").withColumns(
        {"is_active": F.lit(True), "contract_start": F.lit("2020-01-01").cast("date"), "contract_end": F.lit("2021-01-01").cast("date")})
    return wh


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def _plain_invoices(raw):
    """The rows of staging_invoices by joins in the order of their description, united at the end."""
    of = lambda x: F.get_json_object(c(x), "$.id").cast("bigint")
    inv, money = raw("", "invoices"), "decimal(18,2)"
    gone = [r[0] for r in inv.where("invoice_type = 'SR'").select(of("origin")).collect()]
    heads = inv.where("invoice_type = 'RE' AND status <> '100'").select(
        c("id").cast("bigint").alias("invoice_id"), c("invoice_date").cast("date").alias("date_key"), "invoice_number", "header", c("customer_note").cast("bigint").alias("deal_id"),
        of("contact").alias("contact_id"), c("period_from").cast("date").alias("period_from"), c("period_to").cast("date").alias("period_to"), (c("status") == "1000").alias("is_paid"),
        c("pay_date").cast("date").alias("pay_date"), F.when(c("charge_interval") == "P1Y", 12).alias("charge_months"), "currency", c("days_to_pay").cast("int").alias("days_to_pay"),
        c("dunning_level").cast("int").alias("dunning_level")).where(~c("invoice_id").isin(gone))
    lines = raw("", "invoice_items").select(of("invoice").alias("_inv"), c("id").cast("bigint").alias("line_id"), of("part").alias("product_id"), c("name").alias("product_name"),
                                            *[c(n).cast(money).alias(f"{n}_amount") for n in ("net", "tax", "gross")], c("discount").cast(money).alias("discount"))
    parts = raw("", "products").select(c("id").cast("bigint").alias("_part"), "part_number")
    kinds = raw("", "revenue_categories").select(c("product_number").alias("_no"), "is_recurring", c("category").alias("revenue_category"))
    customers = raw("", "customers").select(c("id").cast("bigint").alias("_cust"), c("customer_number").cast("bigint").alias("accounting_id"))
    out = (heads.join(lines, c("_inv") == c("invoice_id"), "left").join(parts, c("_part") == c("product_id"), "left").join(kinds, c("_no") == c("part_number"), "left")
           .join(customers, c("_cust") == c("contact_id"), "left").drop("_inv", "_part", "_no", "_cust"))
    out = out.withColumns({"due_date": F.date_add("date_key", c("days_to_pay")), "revenue_category": F.when(c("is_recurring"), "Monitoring recurring").otherwise(c("revenue_category"))})
    early = raw("", "receipts").select(
        c("id").cast("bigint").alias("invoice_id"), c("voucher_date").cast("date").alias("date_key"), c("description").alias("invoice_number"), of("supplier").alias("contact_id"),
        *[c(n).cast(money).alias(f"{n}_amount") for n in ("net", "tax", "gross")], (c("status") == "1000").alias("is_paid"), c("pay_date").cast("date").alias("pay_date"))
    return union_all([out, early]).distinct()


def test_passes_give_the_rows_of_one(spark, raw, many_passes):
    want = _rows(_plain_invoices(raw))
    wh = _warehouse(spark, raw)
    parts = wh.parts("staging_invoices")
    assert len(parts) > 1 and _rows(wh.ref("staging_invoices")) == want
    ids = [{r.invoice_id for r in part.select("invoice_id").collect()} for part in parts]
    assert sum(map(len, ids)) == len(set().union(*ids))
    assert _rows(_warehouse(spark, raw, store_tables=False).ref("staging_invoices")) == want
    got = _rows(wh.ref("fact_revenue_invoiced"))
    assert len(wh.parts("fact_revenue_invoiced")) == len(parts)
    spark.conf.unset(PASS_ROWS)
    whole = _warehouse(spark, raw)
    assert len(whole.parts("staging_invoices")) == 1 and _rows(whole.ref("fact_revenue_invoiced")) == got and got


def test_lines_of_a_pass_go_with_it(spark, raw, many_passes):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    wh = _warehouse(spark, raw)
    folder = (folder or spark.conf.get("spark.checkpoint.dir")).removeprefix("file://")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    wh.ref("staging_invoices")
    assert not [f for f in set(os.listdir(folder)) - before if f.startswith("invoice_lines")]


def test_all_of_an_invoices_rows_are_united_in_one_place(spark, raw):
    """Rows of invoices were dealt out anew, whole, before they were united: the largest shuffle of the query."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _warehouse(spark, raw, store_tables=False).ref("staging_invoices")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert dealt and not any("header" in line for line in dealt)


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def _stored(df):
    MODELS["one_for_this_test"] = (lambda wh: df, "table")
    try:
        return Warehouse(df.sparkSession, lambda group, table: df, {}, dt.date(2024, 2, 1)).ref("one_for_this_test")
    finally:
        del MODELS["one_for_this_test"]


@pytest.mark.parametrize("write", [lambda df: build_table(df, "t"), checkpointed, _stored], ids=["table", "checkpoint", "model"])
def test_shuffle_files_go_with_the_write(spark, write):
    before = _shuffle_files(spark)
    out = write(spark.range(1000).groupBy((c("id") % 10).alias("k")).count())
    assert len(out.collect()) == 10
    for _ in range(100):   # they are deleted in the background
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before


def test_row_checks_add_up_over_parts(spark):
    MODELS["parts_for_this_test"] = (lambda wh: iter([spark.range(3), spark.range(5, 8), spark.range(2)]), "table")
    ROW_CHECKS["parts_for_this_test"] = [quality.Rule("small", "id > 1"), quality.Rule("known", "id IS NULL")]
    try:
        wh = Warehouse(spark, lambda group, table: None, {}, dt.date(2024, 2, 1))
        assert wh.ref("parts_for_this_test").count() == 8
        assert wh.verdicts["parts_for_this_test"] == {"small": (4, "fail"), "known": (0, "pass")}
    finally:
        del MODELS["parts_for_this_test"], ROW_CHECKS["parts_for_this_test"]
