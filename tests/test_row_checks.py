"""Row checks: one scan for all of them, counts taken while a table is written, failing rows on demand."""

from ledgerloom.operators import quality
from ledgerloom.plans import catalogue

ROOT = "/root/testdata/sf0.001"


def rules():
    return [quality.is_set("k"), quality.is_one_of("v", ["a", "b"], "warn"), quality.holds("k below 3", "k < 3")]


def frame(spark):
    return spark.createDataFrame([(1, "a"), (None, "b"), (3, "c"), (4, None), (5, "x")], "k int, v string")


def test_summary_and_failing_rows(spark):
    got = {r.check: (r.failing, r.severity, r.verdict) for r in quality.row_summary(frame(spark), rules()).collect()}
    assert got == {"k is set": (1, "error", "fail"), "v is known": (2, "warn", "warn"), "k below 3": (3, "error", "fail")}
    assert {(r.k, tuple(r.failed)) for r in quality.failing_rows(frame(spark), rules()).collect()} == {
        (None, ("k is set",)), (3, ("v is known", "k below 3")), (4, ("k below 3",)), (5, ("v is known", "k below 3"))}
    assert {r.verdict for r in quality.row_summary(frame(spark).limit(0), rules()).collect()} == {"pass"}


def test_counted_by_the_write(spark, tmp_path):
    rows, seen = quality.observed(frame(spark), rules())
    rows.write.parquet(str(tmp_path / "t"))
    assert quality.verdicts(seen, rules()) == {"k is set": (1, "fail"), "v is known": (2, "warn"), "k below 3": (3, "fail")}
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5


def test_q15_reads_its_table_once(spark):
    plan = catalogue.queries()["q15_summary"](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
