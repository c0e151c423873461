"""Physical plans: what must not be in them."""

import pytest

from ledgerloom.plans import catalogue

ROOT = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("key", sorted(k for k in catalogue.queries() if not k.startswith("m_")))   # m_: read stored tables
def test_no_nested_loops_and_no_python(spark, no_broadcast, key):
    plan = physical(catalogue.queries()[key](spark, ROOT))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert bad not in plan


@pytest.mark.parametrize("key", ["h02_islands", "d06_scd2_point_in_time", "i06_mrr_change", "d09_spine_expand", "i12_payment_schedule",
                                 "i25_cost_allocation", "w05_running_sum", "i27_customer_margin"])
def test_no_single_partition(spark, no_broadcast, key):
    assert "SinglePartition" not in physical(catalogue.queries()[key](spark, ROOT))


def test_filters_and_columns_reach_the_scan(spark):
    plan = physical(catalogue.queries()["p07_predicates"](spark, ROOT))
    assert "PushedFilters: [In(l_returnflag" in plan or "PushedFilters: [IsNotNull" in plan
    plan = physical(catalogue.queries()["w01_row_number"](spark, ROOT))
    assert "o_totalprice" not in plan


def test_schedule_needs_no_shuffle(spark):
    for key in ("i12_payment_schedule", "i13_aligned_schedule", "i14_outstanding"):
        assert "Exchange" not in physical(catalogue.queries()[key](spark, ROOT))


def test_top_row_is_cut_before_the_shuffle(spark):
    assert physical(catalogue.queries()["p10_dedup_latest"](spark, ROOT)).count("WindowGroupLimit") == 2
