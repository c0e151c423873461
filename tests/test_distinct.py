"""Distinct counts from states agree with counts over the rows, at every grain."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerloom.operators.distinct import count_states, dense_ids, distinct_states, merged_states, trailing_states


def test_states(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), dt.date(2024, 1, 1) + dt.timedelta(days=rng.choice([0, 1, 2, 9, 20, 40])), rng.choice([None, *range(60)])) for _ in range(900)]
    df = spark.createDataFrame(rows, "k string, day date, v int")
    numbered = dense_ids(df, [], "v", "no")
    assert numbered.where("v IS NOT NULL").select("no").distinct().count() == 60
    states = distinct_states(numbered.withColumn("no", F.when(F.col("v").isNotNull(), F.col("no") * 7000)), ["k", "day"], "no")   # many buckets
    assert states.select("bucket").distinct().count() > 5
    count = lambda part: len({v for k, d, v in part if v is not None})
    got = {(r.k, r.day): r.n for r in count_states(states, ["k", "day"], "n").collect()}
    assert got == {key: count([x for x in rows if x[:2] == key]) for key in {x[:2] for x in rows} if count([x for x in rows if x[:2] == key])}
    months = states.withColumn("month", F.trunc("day", "month"))
    got = {r.month: r.n for r in count_states(merged_states(merged_states(months, ["k", "month"]), ["month"]), ["month"], "n").collect()}
    assert got == {m: count([x for x in rows if x[1].replace(day=1) == m]) for m in {x[1].replace(day=1) for x in rows}}
    got = {(r.k, r.day): r.n for r in count_states(trailing_states(states, ["k"], "day", 3), ["k", "day"], "n").collect()}
    for (k, day), n in got.items():
        assert n == count([x for x in rows if x[0] == k and 0 <= (day - x[1]).days < 3]), (k, day)
    assert all((k, d) in got for k, d, v in rows if v is not None)
    assert count_states(distinct_states(numbered.limit(0), ["k"], "no"), ["k"], "n").count() == 0
