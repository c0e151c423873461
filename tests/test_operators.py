"""Edges of single operators: NULLs, ties, empty input, borders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, geo, logic, text
from ledgerloom.operators import aggregate, calendar, history, joins, people, project, quality, ranks
from ledgerloom.operators.ordered import HOT_KEY_ROWS, collapse_islands, hot_keys, neighbours
from ledgerloom.operators.schedule import schedule
from ledgerloom.sources.build import extract, latest_batch
from ledgerloom.sources.catalog import GROUPS, Catalog
from ledgerloom.sources.incremental import incremental_append
from ledgerloom.sources.snapshots import first_snapshot, snapshot_check, snapshot_timestamp

D = dt.date


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def versions(spark, data):
    return spark.createDataFrame(data, "k int, stage string, valid_from date, valid_to date")


def test_logic(spark):
    n = F.lit(None).cast("int")
    assert one(spark, logic.least_strict(F.lit(1), n), logic.greatest_strict(F.lit(1), F.lit(2)), logic.div0(F.lit(3.0), F.lit(0.0)),
               logic.div0(F.lit(3.0), F.lit(2.0)), logic.round_int(F.lit(2.5)), logic.round_int(F.lit(-2.5))) == (None, 2, 0.0, 1.5, 3, -3)
    assert one(spark, text.typed(F.lit(""), "int"), text.typed(F.lit("7"), "int"), text.typed(F.lit("x"), "int")) == (None, 7, None)
    assert one(spark, logic.bucket(F.lit(5), [5, 10], ["a", "b", "c"]), logic.bucket(F.lit(11), [5, 10], ["a", "b", "c"])) == ("a", "c")


def test_dates(spark):
    ts = lambda x: F.lit(x).cast("timestamp_ntz")
    assert one(spark, dates.boundary_diff("minute", ts("2024-01-01 00:00:59"), ts("2024-01-01 00:01:01")),
               dates.timedelta(ts("2024-01-01"), ts("2024-01-02"), "hours")) == (1, 24.0)
    with pytest.raises(ValueError):
        dates.timedelta(ts("2024-01-01"), ts("2024-01-02"), "weeks")
    assert one(spark, dates.clock_minutes(F.lit("24:00")), dates.clean_date(F.lit("0001-01-01"), "0001-01-01", "2006-01-01")) == (1439, None)


def all_hot(spark, key, df):
    spark.conf.set(HOT_KEY_ROWS, "0")
    try:
        return hot_keys(key, df)
    finally:
        spark.conf.unset(HOT_KEY_ROWS)


@pytest.mark.parametrize("cut", [False, True])
def test_islands(spark, cut):
    """NULL is a state of its own, a revisited state a new island, and islands run across the borders of ranges."""
    df = versions(spark, [(1, "a", D(2024, 1, 1), D(2024, 1, 20)), (1, "a", D(2024, 1, 20), D(2024, 2, 10)), (1, "a", D(2024, 2, 10), D(2024, 2, 11)),
                          (1, None, D(2024, 2, 11), D(2024, 2, 12)), (1, None, D(2024, 2, 12), D(2024, 3, 1)), (1, "a", D(2024, 3, 1), None),
                          (2, "b", D(2024, 1, 5), D(9999, 12, 31))])
    hot = all_hot(spark, "k", df) if cut else None
    out = collapse_islands(df, ["k"], ["stage"], "valid_from", "valid_to", hot, count="n")
    got = {(r.k, r.stage, r.valid_from, r.valid_to, r.n) for r in out.collect()}
    assert got == {(1, "a", D(2024, 1, 1), D(2024, 2, 11), 3), (1, None, D(2024, 2, 11), D(2024, 3, 1), 2), (1, "a", D(2024, 3, 1), None, 1),
                   (2, "b", D(2024, 1, 5), D(9999, 12, 31), 1)}
    assert collapse_islands(df.limit(0), ["k"], ["stage"], "valid_from", "valid_to", hot).count() == 0


def test_neighbours_with_null_key(spark):
    df = spark.createDataFrame([(None, D(2024, 1, 1), 1), (None, D(2024, 2, 1), 2), (7, D(2024, 1, 1), 3), (7, D(2024, 2, 1), 4)], "k int, d date, v int")
    out = neighbours(df, ["k"], ["d"], all_hot(spark, "k", df), previous={"p": "v"}, following={"n": "v"})
    assert {(r.v, r.p, r.n) for r in out.collect()} == {(1, None, 2), (2, 1, None), (3, None, 4), (4, 3, None)}


def test_change_history_starts_with_null(spark):
    df = versions(spark, [(1, None, D(2024, 1, 1), None), (1, "a", D(2024, 1, 2), None), (1, "a", D(2024, 1, 3), None), (1, None, D(2024, 1, 4), None)])
    out = history.change_history(df, "k", "stage", "valid_from", ["valid_from"], None)
    assert {(r.stage, r.previous_stage, r.valid_from.day, r.valid_until and r.valid_until.day) for r in out.collect()} == {
        ("a", None, 2, 4), (None, "a", 4, None)}


def test_daily_snapshot(spark):
    df = versions(spark, [(1, "a", D(2024, 1, 1), D(2024, 1, 3)), (1, "b", D(2024, 1, 3), D(2024, 1, 3)), (1, "c", D(2024, 1, 3), D(9999, 12, 31))])
    out = history.daily_snapshot(df, "k", D(2024, 1, 4))
    assert rows(out, "valid_date", "stage", "is_current") == [(D(2024, 1, 1), "a", False), (D(2024, 1, 2), "a", False), (D(2024, 1, 3), "c", False),
                                                              (D(2024, 1, 4), "c", True)]


def test_interval_join_borders(spark):
    facts = spark.createDataFrame([(1, D(2024, 1, 10)), (1, D(2024, 1, 11)), (2, D(2024, 1, 1)), (None, D(2024, 1, 1))], "k int, d date")
    dim = spark.createDataFrame([(1, "x", D(2024, 1, 1), D(2024, 1, 11)), (1, "y", D(2024, 1, 11), D(9999, 12, 31))], "k int, v string, f date, t date")
    half = joins.interval_join(facts, dim, "k", "d", "f", "t")
    assert {(r.k, r.d.day, r.v) for r in half.collect()} == {(1, 10, "x"), (1, 11, "y"), (2, 1, None), (None, 1, None)}
    both = joins.interval_join(facts, dim, "k", "d", "f", "t", "inner", closed="both")
    assert sorted((r.d.day, r.v) for r in both.collect()) == [(10, "x"), (11, "x"), (11, "y")]


def test_overlap_join_reports_each_pair_once(spark):
    a = spark.createDataFrame([(1, D(2024, 1, 1), D(2024, 6, 1))], "k int, af date, at date")
    b = spark.createDataFrame([(1, D(2023, 6, 1), D(2024, 4, 1)), (1, D(2024, 4, 1), D(9999, 12, 31)), (1, D(2024, 6, 1), D(2024, 7, 1))], "k int, bf date, bt date")
    out = joins.overlap_join(a, b, "k", "af", "at", "bf", "bt", (D(2023, 1, 1), D(2024, 12, 31)))
    assert rows(out, "overlap_from", "overlap_to") == [(D(2024, 1, 1), D(2024, 4, 1)), (D(2024, 4, 1), D(2024, 6, 1))]


def test_null_aware_anti(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    sub = lambda *v: spark.createDataFrame([(x,) for x in v], "s int")
    assert rows(joins.null_aware_anti(df, sub(1), "k", "s"), "k") == [(2,)]
    assert joins.null_aware_anti(df, sub(1, None), "k", "s").count() == 0
    assert joins.null_aware_anti(df, sub(), "k", "s").count() == 3


def test_concave_polygon(spark):
    ring = [(0, 0), (30, 0), (30, 30), (15, 10), (0, 30), (0, 0)]
    polys = spark.createDataFrame([("u", [{"lon": float(x), "lat": float(y)} for x, y in ring])], "id string, ring array<struct<lon:double,lat:double>>")
    pts = spark.createDataFrame([(1, 5.0, 5.0), (2, 15.0, 25.0), (3, 2.0, 25.0), (4, 28.0, 25.0), (5, 40.0, 5.0)], "p int, lon double, lat double")
    assert rows(joins.point_in_polygon(pts, polys, "lon", "lat", "ring"), "p") == [(1,), (3,), (4,)]
    assert one(spark, geo.clean_coordinate(F.lit(0.5)), geo.clean_coordinate(F.lit(-50.0))) == (None, -50.0)


def test_schedule_month_end(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 31), D(2024, 5, 1), 1), (2, D(2024, 1, 30), D(2024, 3, 1), 1), (3, D(2024, 1, 1), D(2024, 7, 1), 3),
                                (4, D(2024, 1, 5), D(2024, 9, 1), 0)], "id int, s date, e date, k int")
    chained = rows(schedule(df, "s", "e", "k"), "id", "due_date")
    assert chained == [(1, D(2024, 1, 31)), (1, D(2024, 2, 29)), (1, D(2024, 3, 29)), (1, D(2024, 4, 29)), (2, D(2024, 1, 30)), (2, D(2024, 2, 29)),
                       (3, D(2024, 1, 1)), (3, D(2024, 4, 1)), (4, D(2024, 1, 5))]
    aligned = rows(schedule(df, "s", "e", "k", align="month_start").where("id IN (2, 3)"), "id", "due_date")
    assert aligned == [(2, D(2024, 1, 30)), (2, D(2024, 3, 1)), (3, D(2024, 1, 1)), (3, D(2024, 4, 1))]


def test_surrogate_rank_is_dense_and_distributed(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "k string")
    out = ranks.surrogate_rank(df, ["k"], "sk")
    assert sorted((r.k or "~", r.sk) for r in out.collect()) == [("a", 1), ("b", 2), ("b", 2), ("c", 3), ("~", 4)]
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange SinglePartition") <= 1   # the one row per range that is added up


def test_working_minutes_over_a_weekend(spark):
    cal = calendar.with_holidays(calendar.date_dim(spark, D(2024, 1, 1), D(2024, 1, 31)), [D(2024, 1, 9)])
    df = spark.createDataFrame([(1, "2024-01-05 16:30:00", "2024-01-08 09:15:00"), (2, "2024-01-06 10:00:00", "2024-01-07 11:00:00"),
                                (3, "2024-01-08 12:00:00", "2024-01-10 08:30:00")], "id int, s string, e string").selectExpr(
        "id", "cast(s AS timestamp_ntz) AS s", "cast(e AS timestamp_ntz) AS e")
    out = calendar.working_minutes(df, "s", {"m": F.col("e")}, F.lit(8), F.lit(17), cal)
    assert rows(out, "id", "m") == [(1, 30 + 75), (2, 0), (3, 300 + 30)]


def test_absences(spark):
    a = spark.createDataFrame([(1, "vacation", D(2024, 1, 30), D(2024, 2, 2), True, True), (1, "sick_leave", D(2024, 2, 2), D(2024, 2, 2), False, False),
                               (1, "offsite_work", D(2024, 1, 31), D(2024, 1, 31), False, False)],
                              "employee_id int, kind string, start_date date, end_date date, half_start boolean, half_end boolean")
    out = people.attendance(spark.createDataFrame([], "employee_id int, day date, working_hours double"), people.absence_days(a))
    got = {r.day.day: (r.absence_days, r.absence_type, r.homeoffice_days) for r in out.collect()}
    assert got == {30: (0.5, "vacation", None), 31: (1.0, "vacation", None), 1: (1.0, "vacation", None), 2: (1.0, "sick_leave", None)}


def test_snapshots(spark):
    ts = lambda x: F.expr(f"TIMESTAMP_NTZ'{x} 00:00:00'")
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, v string")
    prev = first_snapshot(old.withColumn("u", ts("2024-01-01")), F.col("u"))
    cur = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "id int, v string")
    run2 = snapshot_timestamp(prev, cur.withColumn("u", F.when(F.col("id") == 1, ts("2024-01-01")).otherwise(ts("2024-02-01"))), "id", "u")
    want = [(1, "a", 1, None), (2, "b", 2, None), (2, None, 1, 2), (3, "c", 1, None), (4, "d", 2, None)]

    def shown(df):
        return sorted(((r.id, r.v, r.valid_from.month, r.valid_to and r.valid_to.month) for r in df.collect()), key=str)
    assert shown(run2) == sorted(want, key=str)
    again = snapshot_timestamp(run2, cur.withColumn("u", F.when(F.col("id") == 1, ts("2024-01-01")).otherwise(ts("2024-02-01"))), "id", "u")
    assert shown(again) == sorted(want, key=str)   # running twice changes nothing
    assert shown(snapshot_check(first_snapshot(old, ts("2024-01-01")), cur, "id", ["v"], ts("2024-02-01"))) == sorted(want, key=str)


def test_incremental_ignores_late_rows(spark, tmp_path):
    def log(*days):
        return spark.createDataFrame([(f"2024-01-{d:02d} 10:00:00",) for d in days], "t string").selectExpr("cast(t AS timestamp_ntz) AS ts")

    def build(df):
        return df.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    target = str(tmp_path / "out")
    incremental_append(log(1, 1, 2), target, "ts", "day", build)
    out = incremental_append(log(1, 1, 1, 2, 2, 3), target, "ts", "day", build)
    assert rows(out.selectExpr("day(day) AS d", "n"), "d", "n") == [(1, 2), (2, 1), (3, 1)]


def test_catalog_and_extract(spark):
    assert len(GROUPS) == 9 and sum(len(t) for t in GROUPS.values()) == 49
    cat = Catalog(spark, {"accounting": "/data/acc", "hr": "lake.hr"})
    assert cat.resolve("accounting", "receipts") == "/data/acc/Voucher.parquet" and cat.resolve("hr", "employees") == "lake.hr.`employees`"
    with pytest.raises(KeyError):
        cat.resolve("crm", "deals")
    from pyspark.sql import types as T
    contract = T.StructType([T.StructField("b", T.LongType(), False), T.StructField("a", T.StringType(), True)])
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert extract(df, contract).dtypes == [("b", "bigint"), ("a", "string")]
    with pytest.raises(ValueError):
        extract(df.drop("b"), contract)
    with pytest.raises(Exception, match="b is NULL"):
        extract(df.withColumn("b", F.lit(None).cast("int")), contract).collect()


def test_latest_batch_and_masks(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 5)), (2, D(2024, 1, 20)), (3, D(2024, 1, 20)), (4, D(2024, 2, 1))], "id int, loaded date")
    assert rows(latest_batch(df, "loaded"), "id") == [(2,), (3,), (4,)]
    people_ = spark.createDataFrame([("Ann", 5.0, 3)], "name string, pay double, n int")
    hidden = project.mask(people_, {"name": "p", "pay": "p", "n": "p"}, "guest", {"p": {"admin"}})
    assert tuple(hidden.first()) == ("**********", 0.0, 0) and tuple(project.mask(people_, {"name": "p"}, "admin", {"p": {"admin"}}).first())[0] == "Ann"


def test_columns_are_declared_and_values_never_cut(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert rows(project.pivot_counts(df, ["k"], "v", "n_", ["b", "a"]), "k", "n_a", "n_b") == [(1, 1, 1), (2, 0, 0)]
    with pytest.raises(Exception, match="no column is declared for v b"):
        project.pivot_counts(df, ["k"], "v", "n_", ["a"]).collect()
    many = spark.range(40_000).selectExpr("1 AS k", "concat('v', id % 20000) AS v")
    found = project.count_map(many, ["k"], "v", "n").first().n
    assert len(found) == 20_000 and set(found.values()) == {2}
    lists = many.groupBy("k").agg(F.array_join(F.collect_list("v"), ";").alias("l"))
    assert project.list_values(lists, ["k"], "l", ";", "v").count() == 20_000
    flags = project.list_flags(spark.createDataFrame([("a;b",), (None,), ("",)], "l string"), "l", ";", ["", "a", "b"])
    assert rows(flags, "has_", "has_a", "has_b") == [(False, False, False), (False, True, True), (True, False, False)]


def test_listagg_and_rollup(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert {(r.k, r.l) for r in aggregate.listagg_distinct(df, ["k"], "v", ";", "l").collect()} == {(1, "a;b"), (2, None)}
    out = aggregate.rollup_on(df, ["k"], "v", [F.count(F.lit(1)).alias("n")])
    assert {(r.k, r.v, r.n) for r in out.collect()} == {(1, "a", 1), (1, "b", 2), (1, "All (aggregated)", 3), (2, "(none)", 1), (2, "All (aggregated)", 1)}


def test_order_of_sorted_reports(spark):
    import __spark_entry__ as entry
    got = [(r.year, r.month, r.status) for r in entry.queries()["u04_order_by"](spark, "/root/testdata/sf0.001").collect()]
    assert got == sorted(got, key=lambda r: (r[0], -r[1], r[2]))


def test_quality(spark):
    df = versions(spark, [(1, "a", D(2024, 1, 2), D(2024, 1, 1)), (2, None, D(2024, 1, 1), None), (2, "b", D(2024, 1, 1), D(2024, 1, 1))])
    assert quality.valid_range(df).count() == 1 and quality.not_null(df, "stage").count() == 1
    assert quality.unique(df, F.col("k")).count() == 1 and quality.unique(df, F.col("k"), where=F.col("stage").isNotNull()).count() == 0
    assert rows(quality.single_active(df, "k", F.col("valid_to").isNull()), "k") == [(1,)]
    assert quality.row_count(df, "k", 0).count() == 0 and quality.row_count(df, "k", 4).count() == 1
