"""The path for hot keys gives the same rows as the plain one."""

import random

import pytest

import __spark_entry__ as entry
from ledgerloom.operators import ordered
from ledgerloom.operators.ordered import HOT_KEY_ROWS
from oracle import rows_of

ROOT = "/root/testdata/sf0.001"
KEYS = ["w01_row_number", "w02_dense_rank", "w05_running_sum", "f15_row_hash", "h01_change_history", "h02_islands", "h04_valid_to_from_next",
        "h07_stage_entry_fix", "h10_merge_histories", "i06_mrr_change", "i09_contracted_revenue", "i15_next_invoice", "i17_mrr_normalise",
        "i18_sales_funnel", "i19_kpi_long", "q05_date_gap"]


def collected(df):
    return rows_of(df.columns, df.collect())


@pytest.mark.parametrize("limit", ["0", "9"])   # all keys hot / some of them
@pytest.mark.parametrize("key", KEYS)
def test_same_rows(spark, key, limit):
    plan = entry.queries()[key]
    want = collected(plan(spark, ROOT))
    spark.conf.set(HOT_KEY_ROWS, limit)
    try:
        assert collected(plan(spark, ROOT)) == want
    finally:
        spark.conf.unset(HOT_KEY_ROWS)


@pytest.fixture
def hot_above(spark):
    def find(limit, key, *dfs):
        spark.conf.set(HOT_KEY_ROWS, str(limit))
        try:
            return ordered.hot_keys(key, *dfs)
        finally:
            spark.conf.unset(HOT_KEY_ROWS)
    return find


def test_hot_keys_stay_in_a_table(spark, hot_above):
    df = spark.range(100).selectExpr("CASE WHEN id < 40 THEN 1 WHEN id < 55 THEN NULL ELSE id END AS k")
    hot = hot_above(10, "k", df)
    assert {r[0] for r in hot.table.collect()} == {1, None} and hot.ranges == 6
    assert hot_above(100, "k", df) is None
    many = hot_above(0, "k", spark.range(30_000).selectExpr("id AS k"))
    assert many.table.count() == 30_000 and many.ranges == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.fixture(scope="module")
def one_day(spark):
    """A key with 600 rows, all of one day, a null key with 300, and keys with few."""
    rng = random.Random(4)
    rows = [(k, "2024-05-01", i, rng.choice("aab"), rng.choice([None, 0.1, 0.2, 1e9, -0.3]), rng.choice([None, None, i])) for k, n in ((1, 600), (None, 300), (2, 3), (3, 9)) for i in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k int, day string, no int, stage string, x double, known int").repartition(5).cache()


def test_a_key_with_one_day_is_split(spark, hot_above, one_day):
    hot = hot_above(50, "k", one_day)
    _, cut = ordered._laid_out(one_day, ["k"], ["day", "no"], hot)
    per_range = [r["count"] for r in cut.groupBy(ordered.CHUNK).count().collect()]
    assert len(per_range) == hot.ranges and max(per_range) < 300 and sum(per_range) == 900


def test_both_layouts_give_the_same_rows(spark, hot_above, one_day):
    by, order = ["k"], ["day", "no"]
    hot = hot_above(50, "k", one_day)
    calls = {"neighbours": lambda h: ordered.neighbours(one_day, by, order, h, {"p": "x", "q": "stage"}, {"n": "no"}),
             "numbers": lambda h: ordered.row_numbers(one_day, by, order, h),
             "sums": lambda h: ordered.running_sum(one_day, by, order, h, "x", "s"),
             "ranks": lambda h: ordered.dense_ranks(one_day, by, "known", h, "up", "down"),
             "islands": lambda h: ordered.collapse_islands(one_day.selectExpr("*", "no + 1 AS until"), by, ["stage"], "no", "until", h, order=order, count="c", sums={"s": "x"}),
             "carried": lambda h: ordered.carry_forward(one_day, by, order, h, ["known", "x"])}
    for name, call in calls.items():
        want, got = call(None), call(hot)
        assert collected(got) == collected(want), name
        assert dict(got.dtypes) == dict(want.dtypes), name


def test_hot_plan_splits_the_key(spark):
    """Under a hot key the window is partitioned by key and range, without one by key alone."""
    def plan(limit):
        spark.conf.set(HOT_KEY_ROWS, limit)
        try:
            return entry.queries()["w05_running_sum"](spark, ROOT)._jdf.queryExecution().optimizedPlan().toString()
        finally:
            spark.conf.unset(HOT_KEY_ROWS)
    assert "_range" in plan("0") and "_range" not in plan("1000000")
