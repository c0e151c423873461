"""Allocation of shared costs and customer margin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.logic import div0
from ledgerloom.operators.ordered import with_totals


def allocate(members: DataFrame, pools: DataFrame, keys: list[str], rules: dict[str, tuple[str, str]],
             min_share: float = 0.3) -> DataFrame:
    """Spread cost pools over the members of a group and period.

    ``rules`` maps a pool column to (eligibility flag column, weight column). ``min_share`` of a pool is
    split evenly among eligible members, the rest by weight. Results are rounded; weights must be exact
    (integer or decimal) so totals do not depend on summation order."""
    totals = []
    for pool, (flag, weight) in rules.items():
        totals.append(F.count_if(F.col(flag)).alias(f"_n_{pool}"))
        totals.append(F.sum(F.when(F.col(flag), F.col(weight))).cast("double").alias(f"_w_{pool}"))
    out = with_totals(members, keys, *totals).join(pools, keys, "left")
    for pool, (flag, weight) in rules.items():
        amount = F.col(pool)
        base = div0(amount, F.col(f"_n_{pool}").cast("double")) * min_share
        share = div0(F.col(weight).cast("double"), F.col(f"_w_{pool}"))
        cost = F.round(base + amount * (1 - min_share) * share)
        out = out.withColumn("allocated_" + pool, F.when(F.col(flag), cost).otherwise(F.lit(0.0)))
    return out.drop(*[p + pool for pool in rules for p in ("_n_", "_w_")])


def allocate_by_usage(usage: DataFrame, costs: DataFrame, keys: list[str], rules: dict[str, tuple[str, str]]) -> DataFrame:
    """Spread costs in proportion to measured usage. ``rules`` maps a cost column to (usage column,
    denominator usage column); naming the denominator keeps a mixed-up one visible."""
    needed = sorted({d for _, d in rules.values()})
    out = with_totals(usage, keys, *[F.sum(d).cast("double").alias("_t_" + d) for d in needed]).join(costs, keys)
    total: Column = F.lit(0.0)
    for cost, (used, denominator) in rules.items():
        part = F.col(cost) * div0(F.col(used).cast("double"), F.col("_t_" + denominator))
        out = out.withColumn("direct_" + cost, part)
        total = total + F.col("direct_" + cost)
    return out.withColumn("direct_total", total).drop(*["_t_" + d for d in needed])


def customer_margin(revenue: DataFrame, direct: DataFrame, indirect: DataFrame, keys: list[str],
                    revenue_cols: list[str], cost_cols: list[str]) -> DataFrame:
    """Revenue, direct and indirect cost per company and month. Costs are negative; rows without any
    revenue or cost are dropped. Each side is unique per key, so the outer joins cannot multiply."""
    out = revenue.join(direct, keys, "full").join(indirect, keys, "full")
    keep = F.lit(False)
    for c in revenue_cols:
        keep = keep | F.coalesce(F.col(c) > 0, F.lit(False))
    for c in cost_cols:
        keep = keep | F.coalesce(F.col(c) < 0, F.lit(False))
    return out.where(keep).select(*keys, *revenue_cols, *cost_cols)
