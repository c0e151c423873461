"""Joins. Equi joins are left to Catalyst and AQE; the rewrites here keep range conditions linear."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.context import spread
from ledgerloom.functions.geo import ring_contains
from ledgerloom.functions.text import norm_name

_CELL = "_cell"


def full_merge(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join with coalesced keys."""
    return a.join(b, keys, "full")


def semi(df: DataFrame, keep: DataFrame, key: str, keep_key: str | None = None) -> DataFrame:
    right = keep.select(F.col(keep_key or key).alias("_k"))
    return df.join(right, F.col(key) == F.col("_k"), "left_semi")


def null_aware_anti(df: DataFrame, sub: DataFrame, key: str, sub_key: str | None = None) -> DataFrame:
    """NOT IN with SQL NULL rules, planned as an ordinary (shuffled) anti join.

    A NULL in a non-empty subquery empties the result; a NULL key never qualifies unless the
    subquery is empty. Those two facts about the subquery come from a one-row aggregate."""
    right = sub.select(F.col(sub_key or key).alias("_k"))
    rows, nulls = right.agg(F.count(F.lit(1)), F.count_if(F.col("_k").isNull())).first()
    if rows == 0:
        return df
    if nulls:
        return df.where(F.lit(False))
    return df.where(F.col(key).isNotNull()).join(right, F.col(key) == F.col("_k"), "left_anti")


def time_span(df: DataFrame, *cols: str) -> tuple[dt.date, dt.date]:
    """First and last day in any of the columns (a one-row aggregate)."""
    lows = [F.min(F.col(c).cast("date")) for c in cols]
    highs = [F.max(F.col(c).cast("date")) for c in cols]
    low, high = df.agg(F.least(*lows) if len(lows) > 1 else lows[0],
                       F.greatest(*highs) if len(highs) > 1 else highs[0]).first()
    return low or dt.date(1970, 1, 1), high or dt.date(1970, 1, 1)


def _cells(df: DataFrame, start: str | Column, end: str | Column, span: tuple[dt.date, dt.date],
           grain: str) -> DataFrame:
    """One copy of an interval per calendar cell it touches inside the span."""
    low, high = F.lit(span[0]), F.lit(span[1])
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    first = F.trunc(F.greatest(start.cast("date"), low), grain) if grain != "day" else F.greatest(start.cast("date"), low)
    last = F.trunc(F.least(end.cast("date"), high), grain) if grain != "day" else F.least(end.cast("date"), high)
    steps = F.sequence(first, last, F.expr(f"INTERVAL 1 {grain}"))
    return df.where(first <= last).withColumn(_CELL, F.explode(steps))


def _cell_of(column: Column, grain: str) -> Column:
    day = column.cast("date")
    return day if grain == "day" else F.trunc(day, grain)


def interval_join(facts: DataFrame, dim: DataFrame, key: str, at: str, start: str, end: str, how: str = "left",
                  closed: str = "left", span: tuple[dt.date, dt.date] | None = None,
                  grain: str = "month") -> DataFrame:
    """Fact row to the version(s) of its key valid at its time.

    Versions are copied once per calendar cell they cover, which turns the range condition into an equi
    join on (key, cell): a key with many facts *and* many versions no longer meets itself in one task.
    ``closed='both'`` is the inclusive BETWEEN, which matches twice on a shared border."""
    span = span or time_span(facts, at)
    right = _cells(dim.withColumnRenamed(key, "_key"), start, end, span, grain)
    if closed == "both":
        inside = (F.col(at) >= F.col(start)) & (F.col(at) <= F.col(end))
    else:
        inside = (F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))
    left = facts.withColumn("_at_cell", _cell_of(F.col(at), grain))
    on = (F.col(key) == F.col("_key")) & (F.col("_at_cell") == F.col(_CELL)) & inside
    return left.join(right, on, how).drop("_key", "_at_cell", _CELL)


def asof_scd2(facts: DataFrame, dim: DataFrame, key: str, at: str, start: str = "valid_from",
              end: str = "valid_to", how: str = "left", span=None, grain: str = "month") -> DataFrame:
    """Point-in-time lookup with half-open versions."""
    return interval_join(facts, dim, key, at, start, end, how, "left", span, grain)


def overlap_join(a: DataFrame, b: DataFrame, key: str, a_from: str, a_to: str, b_from: str, b_to: str,
                 span: tuple[dt.date, dt.date], grain: str = "month") -> DataFrame:
    """Pairs of versions that overlap, with the shared interval as (overlap_from, overlap_to).

    Both sides are cut into calendar cells; a pair is reported by the one cell its overlap starts in.
    ``span`` has to contain every overlap start."""
    left = _cells(a, a_from, a_to, span, grain)
    right = _cells(b.withColumnRenamed(key, "_key"), b_from, b_to, span, grain).withColumnRenamed(_CELL, "_cell_b")
    begins = F.greatest(F.col(a_from), F.col(b_from))
    first_cell = _cell_of(F.greatest(begins.cast("date"), F.lit(span[0])), grain)
    on = ((F.col(key) == F.col("_key")) & (F.col(_CELL) == F.col("_cell_b"))
          & (F.col(a_from) < F.col(b_to)) & (F.col(a_to) > F.col(b_from)) & (F.col(_CELL) == first_cell))
    return (left.join(right, on, "inner").withColumn("overlap_from", begins)
            .withColumn("overlap_to", F.least(F.col(a_to), F.col(b_to))).drop("_key", _CELL, "_cell_b"))


def first_version_join(facts: DataFrame, dim: DataFrame, key: str, at: str, start: str, end: str, first: str,
                       span: tuple[dt.date, dt.date] | None = None, grain: str = "month",
                       how: str = "left") -> DataFrame:
    """As the point-in-time join, but the first version (flag column ``first``) also takes everything
    up to its start. That version simply covers the cells before it as well."""
    span = span or time_span(facts, at)
    opens = F.when(F.col(first), F.lit(span[0]).cast("timestamp_ntz")).otherwise(F.col(start).cast("timestamp_ntz"))
    right = _cells(dim.withColumnRenamed(key, "_key"), opens, F.greatest(F.col(start), F.col(end)), span, grain)
    inside = ((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))) | (F.col(first) & (F.col(at) <= F.col(start)))
    left = facts.withColumn("_at_cell", _cell_of(F.col(at), grain))
    on = (F.col(key) == F.col("_key")) & (F.col("_at_cell") == F.col(_CELL)) & inside
    return left.join(right, on, how).drop("_key", "_at_cell", _CELL)


def full_interval_join(facts: DataFrame, dim: DataFrame, key: str, at: str, start: str, end: str,
                       dim_id: list[str], span=None, grain: str = "month") -> DataFrame:
    """Full outer point-in-time join: left join plus the versions no fact fell into.

    A full outer join cannot be split when one key is hot, a left join and an anti join can.
    ``dim_id`` identifies a version; the key column is coalesced."""
    span = span or time_span(facts, at)
    left = interval_join(facts, dim, key, at, start, end, "left", "left", span, grain)
    used = (interval_join(facts.select(key, at), dim.select(key, *[c for c in dim_id if c != key],
                                                            *[c for c in (start, end) if c not in dim_id]),
                          key, at, start, end, "inner", "left", span, grain).select(*dim_id).distinct())
    rest = dim.join(used, dim_id, "left_anti")
    return left.unionByName(rest, allowMissingColumns=True)


def expand_days(df: DataFrame, start: str | Column, end: str | Column, name: str = "day") -> DataFrame:
    """One row per day in [start, end]. Generated per row: no join to a calendar."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    first, last = start.cast("date"), end.cast("date")
    return df.where(first <= last).withColumn(name, F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))))


def expand_months(df: DataFrame, start: str | Column, end: str | Column, name: str = "month") -> DataFrame:
    """One row per month whose first day lies in [start, end]."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    first, last = start.cast("date"), end.cast("date")
    begin = F.when(F.day(first) == 1, first).otherwise(F.add_months(F.trunc(first, "month"), 1))
    return df.where(begin <= last).withColumn(name, F.explode(F.sequence(begin, last, F.expr("INTERVAL 1 MONTH"))))


def expand_days_grouped(df: DataFrame, keys: list[str], start: str, end: str, name: str = "day",
                        month: str = "month") -> DataFrame:
    """Day expansion for a later ``groupBy(*keys, month, day)``: intervals are cut at month borders, shuffled
    by (keys, month) while they are still intervals, and only then written out as days. The grouping finds
    its rows in place, and a busy key is spread over its months."""
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    out = df.where(first <= last).withColumn(month, F.explode(
        F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("INTERVAL 1 MONTH"))))
    out = spread(out, *keys, month)
    return expand_days(out, F.greatest(first, F.col(month)), F.least(last, F.last_day(F.col(month))), name)


def point_in_polygon(points: DataFrame, polys: DataFrame, lon: str, lat: str, ring: str,
                     cell: float = 10.0, how: str = "inner") -> DataFrame:
    """Points to the areas that contain them.

    Areas are listed under every grid cell their bounding box touches, points under their own cell; the
    exact ring test then runs only on pairs that share a cell."""
    xs, ys = F.transform(ring, lambda p: p["lon"]), F.transform(ring, lambda p: p["lat"])

    def steps(lo: Column, hi: Column) -> Column:
        return F.explode(F.sequence(F.floor(lo / cell), F.floor(hi / cell)))

    areas = polys.withColumn("_cx", steps(F.array_min(xs), F.array_max(xs)))
    areas = areas.withColumn("_cy", steps(F.array_min(ys), F.array_max(ys)))
    left = points.withColumn("_px", F.floor(F.col(lon) / cell)).withColumn("_py", F.floor(F.col(lat) / cell))
    on = (F.col("_px") == F.col("_cx")) & (F.col("_py") == F.col("_cy")) & ring_contains(
        F.col(ring), F.col(lon), F.col(lat))
    return left.join(areas, on, how).drop("_px", "_py", "_cx", "_cy")


def first_match(df: DataFrame, lookups: list[tuple[Column, DataFrame]], name: str, default) -> DataFrame:
    """Several lookups in order of trust, the first hit wins.

    Each lookup is (key expression, table of (key, value)) with unique keys."""
    out, hits = df, []
    for i, (key, table) in enumerate(lookups):
        k, v = table.columns
        pairs = table.select(F.col(k).alias(f"_k{i}"), F.col(v).alias(f"_v{i}"))
        out = out.join(pairs, key == F.col(f"_k{i}"), "left")
        hits.append(F.col(f"_v{i}"))
    out = out.withColumn(name, F.coalesce(*hits, F.lit(default)))
    return out.drop(*[f"_{p}{i}" for i in range(len(lookups)) for p in "kv"])


def norm_join(a: DataFrame, b: DataFrame, a_name: str, b_name: str, how: str = "inner") -> DataFrame:
    """Join on trimmed, lower-cased names."""
    return (a.withColumn("_na", norm_name(F.col(a_name)))
            .join(b.withColumn("_nb", norm_name(F.col(b_name))), F.col("_na") == F.col("_nb"), how)
            .drop("_na", "_nb"))


def flatten(df: DataFrame, column: str, name: str, outer: bool = False) -> DataFrame:
    """One row per array element; ``outer`` keeps rows without elements."""
    return df.withColumn(name, (F.explode_outer if outer else F.explode)(column)).drop(column)


def sk_lookup(fact: DataFrame, dim: DataFrame, key: str, dim_key: str, sk: str, default: int = -1) -> DataFrame:
    """Business key to surrogate key, ``default`` when the dimension has no such member."""
    pairs = dim.select(F.col(dim_key).alias("_k"), F.col(sk).alias("_sk"))
    out = fact.join(pairs, F.col(key) == F.col("_k"), "left")
    return out.withColumn(sk, F.coalesce(F.col("_sk"), F.lit(default))).drop("_k", "_sk")


def impute_avg(df: DataFrame, keys: list[str], column: str, name: str, digits: int | None = None) -> DataFrame:
    """Missing measure filled with the mean of its group. The mean is taken over exact decimals."""
    mean = df.where(F.col(column).isNotNull()).groupBy(*keys).agg(
        (F.sum(F.col(column).cast("decimal(18,2)")).cast("double") / F.count(column)).alias("_mean"))
    if digits is not None:
        mean = mean.withColumn("_mean", F.round("_mean", digits))
    return (df.join(mean, keys, "left").withColumn(name, F.coalesce(F.col(column).cast("double"), F.col("_mean")))
            .drop("_mean"))


def resolve(parts: list[tuple[str, DataFrame]], keys: list[str], attrs: list[str]) -> DataFrame:
    """The same entity from several systems: full outer on the keys, one presence flag per system
    (named by the tag) and each attribute from the first system that has it."""
    out = None
    for tag, df in parts:
        side = df.select(*keys, *[F.col(a).alias(f"_{a}_{tag}") for a in attrs], F.lit(True).alias(tag))
        out = side if out is None else out.join(side, keys, "full")
    tags = [t for t, _ in parts]
    merged = [F.coalesce(*[F.col(f"_{a}_{t}") for t in tags]).alias(a) for a in attrs]
    return out.select(*keys, *merged, *[F.coalesce(F.col(t), F.lit(False)).alias(t) for t in tags])
