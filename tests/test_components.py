"""Connected components stay cheap to plan, whatever the number of rounds."""

from pyspark.sql import functions as F

from ledgerloom.operators.graph import components


def test_size_estimates_do_not_grow_with_rounds(spark):
    """Every round's checkpoint handed on the product of the sizes it was estimated from: numbers of millions of digits after ten rounds."""
    n = 60
    links = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    out = components(links)
    assert out._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1 << 200
    assert sorted((r.v, r.root) for r in out.collect()) == [(v, 0) for v in range(n + 1)]
