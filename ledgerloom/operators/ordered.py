"""Ordered per-key computations that survive a key holding a large share of all rows.

A plain ``Window.partitionBy(key).orderBy(ts)`` sorts a whole key in one task. That is the right plan for
ordinary keys and a dead end for a hot one. ``hot_keys`` counts rows per key (map-side combined) and writes those
above a limit to a small table; only their number comes back. Rows of hot keys are range partitioned by
(key, order) with sampled splitters, so a key is cut wherever its rows are, be they all of one day. The window runs
inside (range, key). What has to cross a border is an associative summary of each key's rows in a range - the last
row, a row count, an exact sum, the first and last island - one small row per (key, range), scanned once and added back.
All other keys take the plain window; without any hot key nothing else is planned. Both give the same rows: sums of
floating numbers are made on decimals, so they do not depend on where a key was cut.

``order`` has to tell a key's rows apart where the result depends on it: rows that tie on it are not parted."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.context import checkpointed

CHUNK = "_range"
_TO_HERE = (Window.unboundedPreceding, 0)


HOT_KEY_ROWS = "spark.ledgerloom.hotKeyRows"   # rows of one key that one task should not have to sort


@dataclass(frozen=True)
class HotKeys:
    """Keys with more rows than one task should handle: a written table of one column, and into how many ranges to cut their rows."""

    table: DataFrame
    key: str
    ranges: int

    def named(self, key: str) -> HotKeys:
        """The same keys where their column has another name."""
        return replace(self, key=key)


def hot_keys(key: str, *dfs: DataFrame) -> HotKeys | None:
    """Every key, null among them, with more rows over all ``dfs`` than the limit; None where there is none. One aggregation over
    the key column alone. The keys stay in a table, however many they are."""
    spark = dfs[0].sparkSession
    limit = int(spark.conf.get(HOT_KEY_ROWS, "1000000"))
    counts = reduce(lambda a, b: a.union(b), [df.select(F.col(key).alias("_hot_key")) for df in dfs]).groupBy("_hot_key").count()
    over = checkpointed(counts.where(F.col("count") > limit))
    keys, rows = over.agg(F.count(F.lit(1)), F.sum("count")).first()
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return HotKeys(over.select("_hot_key"), key, max(2, min(most, -(-rows // max(1, limit))))) if keys else None


def _laid_out(df: DataFrame, keys: list[str], order: list[str], hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys, and rows of hot keys with the number of their range. Both are cut from one written table, and so are the
    ranges, since splitters come from a sample and must not be drawn twice."""
    known = hot.table.withColumn("_hot", F.lit(True))
    marked = checkpointed(df.join(known, F.col(hot.key).eqNullSafe(F.col("_hot_key")), "left").drop("_hot_key"))
    ranged = marked.where("_hot").drop("_hot").repartitionByRange(hot.ranges, *_asc([*keys, *order]))
    return marked.where("_hot IS NULL").drop("_hot"), checkpointed(ranged.withColumn(CHUNK, F.spark_partition_id()))


def _each_layout(df: DataFrame, keys: list[str], order: list[str], hot: HotKeys | None,
                 plain: Callable[[DataFrame], DataFrame], cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    if hot is None:
        return plain(df)
    ordinary, ranged = _laid_out(df, keys, order, hot)
    return plain(ordinary).unionByName(cut(ranged).drop(CHUNK))


def exact(df: DataFrame, column: str) -> tuple[Column, str]:
    """A column in a type whose sums do not depend on their order, and the type to hand the sum back in: floating numbers are summed as
    decimals of 15 places."""
    kind = df.schema[column].dataType.simpleString()
    return (F.col(column).cast("decimal(38,15)"), "double") if kind in ("double", "float") else (F.col(column), "")


def _back(total: Column, kind: str) -> Column:
    return total.cast(kind) if kind else total


def _asc(order: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def join_same(df: DataFrame, other: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi join on like-named keys where NULL matches NULL, as in grouping. Keeps the left keys."""
    right = other.select(*[F.col(k).alias("_k_" + k) for k in keys],
                         *[c for c in other.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col("_k_" + k)) for k in keys])
    return df.join(right, on, how).drop(*["_k_" + k for k in keys])


def _attach(df: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    return join_same(df, small, [*keys, CHUNK])


def neighbours(df: DataFrame, keys: list[str], order: list[str], hot: HotKeys | None,
               previous: dict[str, str] | None = None, following: dict[str, str] | None = None) -> DataFrame:
    """LAG / LEAD by one row. ``previous={"prev_stage": "stage"}`` adds the predecessor's stage.

    ``order`` has to be a total order within a key."""
    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*_asc(order))
        return rows.select("*", *[F.lag(src).over(w).alias(n) for n, src in (previous or {}).items()],
                           *[F.lead(src).over(w).alias(n) for n, src in (following or {}).items()])

    def cut(rows: DataFrame) -> DataFrame:
        inside = Window.partitionBy(*keys, CHUNK).orderBy(*_asc(order))
        across = Window.partitionBy(*keys).orderBy(CHUNK)
        row_no = F.row_number().over(inside)
        out, edges, steps = rows.withColumn("_no", row_no), [], []
        for tag, wanted, pick, move in (("_lag", previous, F.max_by, F.lag), ("_lead", following, F.min_by, F.lead)):
            if wanted:
                row = F.struct(*[F.col(src).alias(name) for name, src in wanted.items()])
                edges.append(pick(row, "_no").alias(tag + "_edge"))
                steps.append((tag, list(wanted), row, move))
        carry = out.groupBy(*keys, CHUNK).agg(*edges)
        carry = carry.select(*keys, CHUNK, *[move(tag + "_edge").over(across).alias(tag + "_carry")
                                             for tag, _, _, move in steps])
        for tag, _, row, move in steps:
            out = out.withColumn(tag, move(row).over(inside))
        out = _attach(out, carry, keys)
        for tag, names, _, _ in steps:
            found = F.coalesce(F.col(tag), F.col(tag + "_carry"))
            for name in names:
                out = out.withColumn(name, found[name])
        return out.drop("_no", *[t for tag, *_ in steps for t in (tag, tag + "_carry")])
    return _each_layout(df, keys, order, hot, plain, cut)


def row_numbers(df: DataFrame, keys: list[str], order: list[str], hot: HotKeys | None, name: str = "rn") -> DataFrame:
    """ROW_NUMBER per key."""
    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*_asc(order))))

    def cut(rows: DataFrame) -> DataFrame:
        across = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        before = (rows.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_n"))
                  .select(*keys, CHUNK, F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_before")))
        inside = Window.partitionBy(*keys, CHUNK).orderBy(*_asc(order))
        out = _attach(rows.withColumn("_inside", F.row_number().over(inside)), before, keys)
        return out.withColumn(name, (F.col("_inside") + F.col("_before")).cast("int")).drop("_inside", "_before")
    return _each_layout(df, keys, order, hot, plain, cut)


def running_sum(df: DataFrame, keys: list[str], order: list[str], hot: HotKeys | None, value: str,
                name: str) -> DataFrame:
    """Cumulative sum per key up to and including the row."""
    number, kind = exact(df, value)

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*_asc(order)).rowsBetween(*_TO_HERE)
        return rows.withColumn(name, _back(F.sum(number).over(w), kind))

    def cut(rows: DataFrame) -> DataFrame:
        across = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        before = (rows.groupBy(*keys, CHUNK).agg(F.sum(number).alias("_s"))
                  .select(*keys, CHUNK, F.sum("_s").over(across).alias("_before")))
        inside = Window.partitionBy(*keys, CHUNK).orderBy(*_asc(order)).rowsBetween(*_TO_HERE)
        out = _attach(rows.withColumn("_local", F.sum(number).over(inside)), before, keys)
        total = F.when(F.col("_before").isNull(), F.col("_local")).otherwise(
            F.col("_before") + F.coalesce(F.col("_local"), F.col("_before") * 0))
        return out.withColumn(name, _back(total, kind)).drop("_local", "_before")
    return _each_layout(df, keys, order, hot, plain, cut)


def dense_ranks(df: DataFrame, keys: list[str], column: str, hot: HotKeys | None, name: str,
                desc_name: str | None = None) -> DataFrame:
    """DENSE_RANK of ``column`` per key, ascending and optionally descending.

    Ranks the distinct (key, value) pairs, so repeated values cost nothing after the map side."""
    if hot is None:
        w = Window.partitionBy(*keys)
        out = df.withColumn(name, F.dense_rank().over(w.orderBy(F.col(column).asc_nulls_last())))
        return out.withColumn(desc_name, F.dense_rank().over(w.orderBy(F.col(column).desc_nulls_first()))) if desc_name else out
    ranked = row_numbers(df.select(*keys, column).distinct(), keys, [column], hot, name)
    if desc_name:
        ranked = with_totals(ranked, keys, F.max(name).alias("_all")).withColumn(desc_name, F.col("_all") + 1 - F.col(name)).drop("_all")
    return join_same(df, ranked, [*keys, column])


def with_totals(df: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    """Whole-partition aggregates next to every row (SUM/MIN/MAX/COUNT OVER without ORDER BY).

    Pre-aggregates and joins: the detail rows of a hot key can then be split over many tasks."""
    if not keys:
        raise ValueError("with_totals needs at least one key")
    return join_same(df, df.groupBy(*keys).agg(*aggs), keys)


def with_first_last(df: DataFrame, keys: list[str], order: list[str], first: dict[str, str] | None = None,
                    last: dict[str, str] | None = None) -> DataFrame:
    """FIRST_VALUE / LAST_VALUE over the whole partition."""
    rank = F.struct(*[F.col(c) for c in order])
    aggs = [F.min_by(F.struct(F.col(src)), rank)[src].alias(name) for name, src in (first or {}).items()]
    aggs += [F.max_by(F.struct(F.col(src)), rank)[src].alias(name) for name, src in (last or {}).items()]
    return with_totals(df, keys, *aggs)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in the given order; a hash of the whole row settles ties, so a rerun picks the same. The
    filter on row_number lets Spark cut every map task to one row per key before the shuffle, so hot keys arrive reduced."""
    told = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    w = Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*told), F.xxhash64(F.lit(1), *told))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def collapse_islands(df: DataFrame, keys: list[str], state: list[str], start: str, end: str, hot: HotKeys | None,
                     order: list[str] | None = None, count: str | None = None,
                     sums: dict[str, str] | None = None, also: list[str] | None = None) -> DataFrame:
    """Gaps and islands: consecutive versions of a key with equal ``state`` become one interval.
    Columns in ``also`` do not start an island, but an island is reported once per combination of them.

    Step 1 collapses inside (key, range); without hot keys that is all. Only the first and last island of a range can continue in a
    neighbouring one, so step 2 lines up just those per key; inner islands are spread over all tasks."""
    order = order or [start, end]
    sums, also = sums or {}, also or []
    count = count or "_versions"
    here = F.struct(*[F.col(c) for c in state])
    kinds = {name: exact(df, src) for name, src in sums.items()}
    totals = [F.sum(number).alias(name) for name, (number, _) in kinds.items()]

    def inside(rows: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*_asc(order))
        out = rows.withColumn("_new", (~here.eqNullSafe(F.lag(here).over(w))).cast("int"))
        out = out.withColumn("_no", F.sum("_new").over(w.rowsBetween(*_TO_HERE)))
        return out.groupBy(*by, "_no", *state, *also).agg(F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias(count), *totals)

    def plain(rows: DataFrame) -> DataFrame:
        return inside(rows, keys).drop("_no")

    def cut(rows: DataFrame) -> DataFrame:
        out = inside(rows, [*keys, CHUNK]).withColumn("_top", F.max("_no").over(Window.partitionBy(*keys, CHUNK)))
        edge = (F.col("_no") == 1) | (F.col("_no") == F.col("_top"))
        out = out.withColumn("_lane", F.when(edge, F.lit(0)).otherwise(
            1 + F.pmod(F.xxhash64(CHUNK, "_no"), F.lit(1 << 20))))
        w = Window.partitionBy(*keys, "_lane").orderBy(CHUNK, "_no")
        same_chunk = F.col(CHUNK).eqNullSafe(F.lag(CHUNK).over(w)) & F.lag("_no").over(w).isNotNull()
        goes_on = ((same_chunk & (F.col("_no") == F.lag("_no").over(w)))
                   | (here.eqNullSafe(F.lag(here).over(w)) & (F.col("_lane") == 0) & ~same_chunk))
        out = out.withColumn("_new", F.when(goes_on, 0).otherwise(1))
        out = out.withColumn("_island", F.sum("_new").over(w.rowsBetween(*_TO_HERE)))
        return out.groupBy(*keys, "_lane", "_island", *state, *also).agg(
            F.min(start).alias(start), F.max(end).alias(end), F.sum(count).alias(count),
            *[F.sum(name).alias(name) for name in sums]).drop("_lane", "_island")
    out = _each_layout(df, keys, order, hot, plain, cut).drop("_versions")
    return out.withColumns({name: _back(F.col(name), kind) for name, (_, kind) in kinds.items() if kind})


def carry_forward(df: DataFrame, keys: list[str], order: list[str], hot: HotKeys | None,
                  columns: list[str]) -> DataFrame:
    """Replace NULL by the last known value of the key, column by column."""
    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*_asc(order)).rowsBetween(*_TO_HERE)
        return rows.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})

    def cut(rows: DataFrame) -> DataFrame:
        inside = Window.partitionBy(*keys, CHUNK).orderBy(*_asc(order))
        out = rows.withColumn("_no", F.row_number().over(inside))
        across = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"))) for c in columns}
        carry = out.groupBy(*keys, CHUNK).agg(
            *[F.max_by(known[c], F.when(F.col(c).isNotNull(), F.col("_no"))).alias("_e_" + c) for c in columns])
        carry = carry.select(*keys, CHUNK, *[F.last("_e_" + c, ignorenulls=True).over(across).alias("_c_" + c)
                                             for c in columns])
        for c in columns:
            out = out.withColumn("_l_" + c, F.last(c, ignorenulls=True).over(inside.rowsBetween(*_TO_HERE)))
        out = _attach(out, carry, keys)
        for c in columns:
            out = out.withColumn(c, F.coalesce(F.col("_l_" + c), F.col("_c_" + c)["v"]))
        return out.drop("_no", *[p + c for c in columns for p in ("_l_", "_c_")])
    return _each_layout(df, keys, order, hot, plain, cut)
