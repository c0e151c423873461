"""What a run of the history store reads and writes, runs that died, replays, old states, and changes of columns."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.context import Context
from ledgerloom.models import Warehouse
from ledgerloom.plans.rawdata import warehouse
from ledgerloom.sources.history import HistoryStore
from ledgerloom.sources.snapshots import first_snapshot, snapshot_timestamp

def day(n):
    return dt.datetime(2024, 1, n)


def rows(spark, data, schema="id int, v string, at timestamp_ntz"):
    return spark.createDataFrame(data, schema)


def shown(df):
    return sorted(((r.id, r.v, r.valid_from, r.valid_to) for r in df.collect()), key=str)


def files(folder):
    return {os.path.relpath(f, folder): os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)}


@pytest.fixture
def store(spark, tmp_path):
    made = HistoryStore(spark, str(tmp_path / "h"), "id", buckets=8)
    made.apply(rows(spark, [(i, "a", day(1)) for i in range(100)]), F.col("at"), "one")
    return made


def test_a_run_writes_only_buckets_with_a_change(spark, store):
    before = files(store.folder)
    store.apply(rows(spark, [(7, "b", day(2))]), F.col("at"), "two")
    after = files(store.folder)
    new = set(after) - set(before)
    assert {k: after[k] for k in before} == before
    assert {os.path.dirname(f).split("/")[0] for f in new} == {"open", "closed"} and len({f.split("/")[2] for f in new if f.startswith("open")}) == 1
    assert [f.split("/")[1:3] for f in new if f.startswith("closed")] == [["run=2", "closed_on=2024-01-02"]]
    store.apply(rows(spark, [(8, "b", day(3))]), F.col("at"), "three")
    assert not any(f.startswith("closed/run=1") for f in set(files(store.folder)) - set(after))


def test_a_run_reads_no_closed_versions(spark, store):
    store.apply(rows(spark, [(7, "b", day(2))]), F.col("at"), "two")
    for f in glob.glob(f"{store.folder}/closed/**/*.parquet", recursive=True):
        os.truncate(f, 0)   # a run that read them would fail
    assert store.apply(rows(spark, [(7, "c", day(3)), (9, "d", day(3))]), F.col("at"), "three") == 3


def test_old_states_and_replays(spark, store):
    first = shown(store.history())
    assert store.apply(rows(spark, [(1, "b", day(2)), (200, "n", day(2))]), F.col("at"), "two") == 2
    second = shown(store.history())
    assert store.apply(rows(spark, [(1, "b", day(2)), (200, "n", day(2))]), F.col("at"), "two") == 2   # the same batch
    assert store.apply(rows(spark, [(1, "late", day(1))]), F.col("at"), "late") == 3                      # no newer than what is open
    assert shown(store.history()) == second and shown(store.history(1)) == first and shown(store.history(2)) == second
    assert (1, "a", day(1), day(2)) in second and (1, "b", day(2), None) in second and (200, "n", day(2), None) in second and len(second) == 102


def test_a_run_that_died_changes_nothing(spark, store, monkeypatch):
    before = shown(store.history())
    change = rows(spark, [(1, "b", day(2)), (2, "b", day(2))])
    real = HistoryStore._bucket
    calls = []

    def dies(self, key):
        calls.append(1)
        if len(calls) == 2:   # after the closed versions are written, before the open ones
            raise RuntimeError("lost")
        return real(self, key)
    monkeypatch.setattr(HistoryStore, "_bucket", dies)
    with pytest.raises(RuntimeError, match="lost"):
        store.apply(change, F.col("at"), "two")
    monkeypatch.setattr(HistoryStore, "_bucket", real)
    assert glob.glob(f"{store.folder}/closed/run=2/*/*.parquet") and shown(store.history()) == before
    assert store.apply(change, F.col("at"), "two") == 2
    assert shown(store.history()) == sorted([x for x in before if x[0] not in (1, 2)] + [(i, v, *t) for i in (1, 2) for v, t in (("a", (day(1), day(2))), ("b", (day(2), None)))], key=str)


def test_several_changes_of_a_key_in_a_batch(spark, store):
    store.apply(rows(spark, [(1, "c", day(4)), (1, "b", day(2)), (1, "d", day(6)), (1, "d", day(6)), (None, "x", day(6))]), F.col("at"), "two")
    assert [x for x in shown(store.history()) if x[0] == 1] == [(1, "a", day(1), day(2)), (1, "b", day(2), day(4)), (1, "c", day(4), day(6)), (1, "d", day(6), None)]
    assert store.history().where("id IS NULL").count() == 0


def test_agrees_with_the_snapshot_of_whole_tables(spark, store):
    state = [(i, "b" if i % 3 == 0 else "a", day(5) if i % 3 == 0 else day(1)) for i in range(0, 120, 2)]
    old = first_snapshot(rows(spark, [(i, "a", day(1)) for i in range(100)]), F.col("at"))
    want = snapshot_timestamp(old, rows(spark, state), "id", "at")
    store.apply(rows(spark, state), F.col("at"), "two")
    assert shown(store.history()) == shown(want)


def test_columns_come_and_go(spark, store):
    store.apply(rows(spark, [(1, 5, day(2))], "id int, extra int, at timestamp_ntz"), F.col("at"), "two")
    got = {(r.id, r.v, r.extra, r.valid_to) for r in store.history().where("id < 3").collect()}
    assert got == {(0, "a", None, None), (1, "a", None, day(2)), (1, None, 5, None), (2, "a", None, None)}


def test_state_by_comparison(spark, tmp_path):
    made = HistoryStore(spark, str(tmp_path / "c"), "id", buckets=4)
    made.apply_state(rows(spark, [(1, None), (2, "x"), (3, "y")], "id int, v string"), ["v"], F.lit(day(1)).cast("timestamp_ntz"), "one")
    made.apply_state(rows(spark, [(1, "n"), (2, "x"), (4, "z")], "id int, v string"), ["v"], F.lit(day(2)).cast("timestamp_ntz"), "two")
    assert shown(made.history()) == sorted([(1, None, day(1), day(2)), (1, "n", day(2), None), (2, "x", day(1), None), (3, "y", day(1), None), (4, "z", day(2), None)], key=str)


def test_an_empty_store_and_an_empty_batch(spark, tmp_path):
    made = HistoryStore(spark, str(tmp_path / "e"), "id")
    with pytest.raises(ValueError, match="nothing published"):
        made.history()
    assert made.apply(rows(spark, []), F.col("at"), "one") == 1 and made.history().count() == 0
    assert made.apply(rows(spark, [(1, "a", day(1))]), F.col("at"), "two") == 2 and made.history().count() == 1


def test_the_tracking_model_reads_only_new_days(spark, tmp_path):
    """The log is partitioned by day; days that are loaded cannot be read any more, and the second run does not miss them."""
    log = str(tmp_path / "log")
    ctx = Context(spark, "/root/testdata/sf0.001")
    base = warehouse(ctx)
    events = ctx.table("events").select(F.col("ts").cast("date").alias("event_date"), "user_id")
    want = {(r.day, r.user_id): r.n for r in events.groupBy(F.col("event_date").alias("day"), "user_id").agg(F.count("*").alias("n")).collect()}

    def run():
        source = lambda g, t: spark.read.schema("user_id bigint, event_date date").parquet(log) if g == "portal_tracking" else base.source(g, t)
        return {(r.day, r.user_id): r.count_queries for r in Warehouse(spark, source, {}, dt.date(2024, 2, 1), state=str(tmp_path / "state")).ref("staging_api_tracking").collect()}
    cut = F.lit(dt.date(2024, 1, 16))
    events.where(F.col("event_date") < cut).write.partitionBy("event_date").parquet(log)
    assert run() == {k: n for k, n in want.items() if k[0] < dt.date(2024, 1, 16)}
    for f in glob.glob(f"{log}/event_date=*/*.parquet"):
        os.truncate(f, 0)
    events.where(F.col("event_date") >= cut).write.mode("append").partitionBy("event_date").parquet(log)
    spark.catalog.refreshByPath(log)
    assert run() == want
