"""Recurring revenue: the published example and its edges."""

import datetime as dt

import pytest

from ledgerloom.operators.ordered import HOT_KEY_ROWS
from ledgerloom.operators.revenue import churn_rows, mrr_changes, mrr_daily, revenue_levels

D = dt.date
AS_OF = D(2021, 12, 23)
# Golden rows: six subscriptions of two companies (subscription, company, start, end, amount) ...
SUBS = [(1, 1, D(2021, 12, 13), D(2021, 12, 14), "15"), (2, 1, D(2021, 12, 13), D(2021, 12, 15), "20"),
        (3, 1, D(2021, 12, 21), D(2021, 12, 22), "39"), (5, 2, D(2021, 12, 16), D(2021, 12, 18), "15"),
        (6, 2, D(2021, 12, 18), D(2021, 12, 20), "20"), (7, 2, D(2021, 12, 20), None, "15")]
# ... and what they come to, day by day: (company, day of December, category, revenue).
GOLDEN = ([(1, 13, "new", 35), (1, 14, "downgrade", 20), (1, 15, "churn", 0)] + [(1, d, "none", 0) for d in range(16, 21)]
          + [(1, 21, "reactivation", 39), (1, 22, "churn", 0), (2, 16, "new", 15), (2, 17, "none", 15), (2, 18, "upgrade", 20),
             (2, 19, "none", 20), (2, 20, "downgrade", 15)] + [(2, d, "none", 15) for d in range(21, 24)])


def subs(spark, rows):
    df = spark.createDataFrame(rows, "subscription_id int, company_id int, start_date date, end_date date, amount string")
    return df.selectExpr("*", "cast(amount AS decimal(18,2)) AS monthly_amount")


@pytest.mark.parametrize("limit", ["1000000", "0"])
def test_golden_rows(spark, limit):
    spark.conf.set(HOT_KEY_ROWS, limit)
    try:
        out = mrr_changes(revenue_levels(subs(spark, SUBS), AS_OF), AS_OF).collect()
    finally:
        spark.conf.unset(HOT_KEY_ROWS)
    got = sorted((r.company_id, r.date.day, r.change_category, int(r.monthly_revenue)) for r in out)
    assert got == sorted(GOLDEN)


def test_daily_span_and_churn(spark):
    levels = revenue_levels(subs(spark, SUBS), AS_OF)
    days = {(r.company_id, r.date.day): r for r in mrr_daily(levels).collect()}
    assert len(days) == 10 + 8
    assert days[(1, 13)].is_first_date and days[(1, 21)].is_last_date and not days[(1, 15)].is_active
    churn = [(r.company_id, r.date) for r in churn_rows(levels, AS_OF).collect()]
    assert churn == [(1, D(2021, 12, 22))]


def test_churn_after_the_series(spark):
    """Two subscriptions of one company; the zero row after the series is added exactly once."""
    rows = [(1, 9, D(2021, 1, 1), D(2021, 1, 3), "5"), (2, 9, D(2021, 1, 1), D(2021, 1, 1), "7")]
    out = mrr_changes(revenue_levels(subs(spark, rows), AS_OF), AS_OF).orderBy("date").collect()
    assert [(r.date.day, r.change_category) for r in out] == [(1, "new"), (2, "none"), (3, "churn")]
