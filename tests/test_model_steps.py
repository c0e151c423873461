"""Steps that the warehouse models share do no work twice."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.context import Context
from ledgerloom.models import crm
from ledgerloom.plans import rawdata


@pytest.fixture
def root(spark, tmp_path):
    """Few rows of the tables that the relations of the models are made of."""
    at = F.expr("TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, id)")
    kinds = F.array(*[F.lit(k) for k in ("view", "click", "error", "signup")])
    tables = {
        "events": spark.range(40).select(F.col("id").alias("event_id"), at.alias("ts"), (F.col("id") % 7).alias("user_id"), F.get(kinds, (F.col("id") % 4).cast("int")).alias("event_type"),
                                         F.col("id").cast("double").alias("value")),
        "customer": spark.range(9).select(F.col("id").alias("c_custkey"), F.lit("C").alias("c_name"), F.lit(1).alias("c_nationkey"), F.lit(5.0).alias("c_acctbal"), F.lit("M").alias("c_mktsegment")),
        "supplier": spark.range(3).select(F.col("id").alias("s_suppkey"), F.lit("S").alias("s_name"), F.lit(1).alias("s_nationkey"), F.lit(5.0).alias("s_acctbal")),
        "part": spark.range(3).select(F.col("id").alias("p_partkey"), F.lit("P").alias("p_name"), F.lit("T").alias("p_type"), F.lit(5.0).alias("p_retailprice"))}
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("table", ["companies", "tickets"])
def test_known_ids_need_no_histories(spark, root, monkeypatch, table):
    """The ids a source still knows were taken from all snapshots, with a count of all events for each such read."""
    ctx = Context(spark, root)
    want = sorted(r.id for r in rawdata.snapshots(ctx)[table].select("id").collect())
    monkeypatch.setattr(rawdata, "snapshots", lambda ctx: pytest.fail("snapshots built for a list of ids"))
    assert sorted(r.id for r in rawdata.source(ctx, "crm", table).collect()) == want


def test_hot_deals_are_counted_without_their_histories(spark, root, monkeypatch):
    plans, count = [], crm.hot_keys

    def seen(key, *dfs):
        plans.append((key, dfs[0]._jdf.queryExecution().optimizedPlan().toString()))
        return count(key, *dfs)
    monkeypatch.setattr(crm, "hot_keys", seen)
    rawdata.warehouse(Context(spark, root), store_tables=True).ref("staging_deals")
    assert plans and not any(word in plan for _, plan in plans for word in ("Window", "Join"))


def test_ticket_versions_are_written_before_they_are_counted(spark, root, monkeypatch):
    plans, count = [], crm.hot_keys

    def seen(key, *dfs):
        plans.append(dfs[0]._jdf.queryExecution().optimizedPlan().toString())
        return count(key, *dfs)
    monkeypatch.setattr(crm, "hot_keys", seen)
    rawdata.warehouse(Context(spark, root), store_tables=True).ref("staging_tickets")
    assert plans and not any(word in plan for plan in plans for word in ("Window", "Join"))


def test_links_as_json_writes_them(spark):
    rows = spark.createDataFrame([(1, 2), (None, 2), (1, None), (None, None), (-5, 0)], "a long, b long")
    a, b = F.col("a"), F.col("b")
    one = [F.when(x.isNotNull(), F.struct(x.cast("string").alias("id"), F.lit("x").alias("type"))) for x in (a, b)]
    rows = rows.select(rawdata.links(a, b).alias("got"), F.to_json(F.filter(F.array(*one), lambda x: x.isNotNull())).alias("want"),
                       rawdata.ref(a).alias("got_ref"), F.to_json(F.struct(a.cast("string").alias("id"))).alias("want_ref"))
    assert [r for r in rows.collect() if r.got != r.want or r.got_ref != r.want_ref] == []
