"""Aggregation shapes the built-in functions do not cover in one call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_if(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def count_distinct_if(cond: Column, value: Column) -> Column:
    return F.count_distinct(F.when(cond, value))


def listagg_distinct(df: DataFrame, keys: list[str], column: str, sep: str, name: str) -> DataFrame:
    """Distinct values of a group, sorted and joined; NULL when there are none. Duplicates are gone before the values of a group
    meet, so a task holds the group's text, which is the result, and nothing more."""
    joined = F.array_join(F.array_sort(F.collect_list(column)), sep)
    return df.select(*keys, column).distinct().groupBy(*keys).agg(F.nullif(joined, F.lit("")).alias(name))


def rollup_on(df: DataFrame, keys: list[str], roll: str, aggs: list[Column],
              label: str = "All (aggregated)", missing: str = "(none)") -> DataFrame:
    """GROUP BY keys, ROLLUP(roll): the detail rows plus one total row per ``keys``."""
    named = df.withColumn(roll, F.coalesce(F.col(roll), F.lit(missing)))
    key_cols = [F.col(k) for k in keys]
    sets = named.groupingSets([[*key_cols, F.col(roll)], key_cols], *key_cols, F.col(roll)).agg(*aggs)
    return sets.withColumn(roll, F.coalesce(F.col(roll), F.lit(label)))


def pivot_min(df: DataFrame, keys: list[str], column: str, value: str, names: dict[str, str]) -> DataFrame:
    """Earliest ``value`` per category as one column each; ``names`` maps output column to category."""
    return df.groupBy(*keys).agg(*[F.min(F.when(F.col(column) == F.lit(cat), F.col(value))).alias(name)
                                   for name, cat in names.items()])


def unpivot(df: DataFrame, ids: list[str], cols: list[str], name: str, value: str,
            drop_nulls: bool = True) -> DataFrame:
    """Wide to long."""
    out = df.unpivot(ids, cols, name, value)
    return out.where(F.col(value).isNotNull()) if drop_nulls else out


def debit_credit(df: DataFrame, keys: list[str], credit: list[str], debit: list[str],
                 names: list[str]) -> DataFrame:
    """Ledger with credit and debit columns to signed long form: one C and one D row per group.
    One aggregation for both sides, then a two-element explode of the sums."""
    sums = df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in [*credit, *debit]])
    side = F.explode(F.array(
        F.struct(F.lit("C").alias("credit_debit"), *[F.col(c).alias(n) for c, n in zip(credit, names)]),
        F.struct(F.lit("D").alias("credit_debit"), *[F.col(c).alias(n) for c, n in zip(debit, names)])))
    return sums.select(*keys, side.alias("_side")).select(*keys, "_side.*")
