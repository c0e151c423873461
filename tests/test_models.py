"""Every warehouse model runs on raw relations derived from the smallest data set, and they fit together."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.context import Context
from ledgerloom.models import MODELS
from ledgerloom.operators import quality
from ledgerloom.plans.rawdata import warehouse

EMPTY = {"deals_with_several_companies"}   # a check: no row means it passed
c = F.col


@pytest.fixture(scope="module")
def wh(spark):
    return warehouse(Context(spark, "/root/testdata/sf0.001"), store_tables=True)


@pytest.mark.parametrize("name", sorted(MODELS))
def test_model_runs(wh, name):
    assert (wh.ref(name).count() > 0) == (name not in EMPTY)


@pytest.mark.parametrize("name,keys", [
    ("dim_company", ["company_sk"]), ("dim_deal", ["deal_stage_sk"]), ("dim_owner", ["owner_sk"]), ("dim_site", ["site_sk"]), ("dim_date", ["date_key"]),
    ("dim_country", ["country_sk"]), ("staging_stages", ["object_type", "stage_id"]), ("staging_contacts", ["contact_id"]), ("staging_sites", ["site_id"]),
    ("fact_recurring_revenue_daily", ["company_id", "date"]), ("fact_deals", ["deal_id"]), ("mart_customer_margin", ["company_sk", "month"]),
    ("fact_deal_cohorts_monthly", ["id"]), ("fact_attendances", ["employee_id", "day"])])
def test_keys_are_unique(wh, name, keys):
    assert quality.unique(wh.ref(name), *[c(k) for k in keys]).count() == 0


def test_histories_have_no_gaps(wh):
    deals = wh.ref("staging_deals")
    assert quality.time_gaps(deals, "deal_id", None).count() == 0
    assert quality.single_active(deals, "deal_id", c("is_active")).count() == 0
    owners = wh.ref("dim_owner").where("employee_id IS NOT NULL")
    assert quality.date_gaps(owners, "employee_id", None).count() == 0
    assert quality.valid_range(wh.ref("dim_deal")).count() == 0


def test_facts_point_into_dimensions(wh):
    for fact, key, dim in [("fact_engagements", "company_sk", "dim_company"), ("fact_engagements", "deal_stage_sk", "dim_deal"),
                           ("fact_site_ingestions", "company_sk", "dim_company"), ("fact_revenue_invoiced", "company_sk", "dim_company")]:
        assert quality.relationship(wh.ref(fact), key, wh.ref(dim), key).count() == 0, fact


def test_margin_keeps_revenue(wh):
    """Nothing is lost on the way from paid invoices to the margin report."""
    paid = wh.ref("fact_revenue_invoiced").where("is_paid").agg(F.sum("recurring_amount"), F.sum("non_recurring_amount")).first()
    report = wh.ref("mart_customer_margin").agg(F.sum("recurring_revenue"), F.sum("nonrecurring_revenue")).first()
    assert tuple(paid) == tuple(report)


def test_row_checks_come_with_the_write(wh):
    for name in ("dim_company", "dim_deal", "dim_ticket"):
        wh.ref(name)
        assert wh.verdicts[name] and all(verdict == "pass" for _, verdict in wh.verdicts[name].values()), name
