"""Projection, filtering, set operations and schema shaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import typed


def typed_select(df: DataFrame, spec: dict[str, tuple[str, str]]) -> DataFrame:
    """``{"amount": ("raw_amount", "decimal(10,2)")}``: rename and cast raw text, '' is NULL."""
    return df.select(*[typed(F.col(src), kind).alias(out) for out, (src, kind) in spec.items()])


def star_except(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def lookup_labels(df: DataFrame, column: str, labels: DataFrame, name: str, default: str) -> DataFrame:
    """Code to label through a two-column table ``(code, label)`` with a default for unknown codes."""
    pairs = labels.select(F.col(labels.columns[0]).alias("_code"), F.col(labels.columns[1]).alias(name))
    joined = df.join(pairs, F.col(column) == F.col("_code"), "left").drop("_code")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(default)))


def current(df: DataFrame, end: str = "valid_to", history_cols: tuple[str, ...] = ("valid_from", "valid_to"),
            ) -> DataFrame:
    """Open versions only, without the history columns."""
    still_open = F.col(end).isNull() | (F.year(end) == 9999)
    return df.where(still_open).drop(*history_cols)


def with_unknown(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Append the member facts with no match point at; columns not named are NULL."""
    row = df.sparkSession.range(1).select(
        *[F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return df.unionByName(row)


def mask(df: DataFrame, policies: dict[str, str], role: str, privileged: dict[str, set[str]]) -> DataFrame:
    """Hide tagged columns from roles a policy does not list.

    ``policies`` maps column to policy, ``privileged`` maps policy to the roles that see the value."""
    out = df
    for column, policy in policies.items():
        if role in privileged[policy]:
            continue
        kind = df.schema[column].dataType
        hidden = F.lit("**********") if isinstance(kind, T.StringType) else F.lit(0).cast(kind)
        out = out.withColumn(column, hidden)
    return out


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """Bag union by name; columns a relation lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def _declared(value: Column, values: list, what: str) -> Column:
    """``value``, an error if it is none of ``values``."""
    known = value.isNull() | value.isin(*values)
    return F.when(known, value).otherwise(F.raise_error(F.concat(F.lit(f"no column is declared for {what} "), value.cast("string"))).cast("string"))


def pivot_counts(df: DataFrame, keys: list[str], column: str, prefix: str, values: list[str]) -> DataFrame:
    """One count column for each declared value, 0 where a key has none. Columns are a contract, so a value that is not declared is an
    error; ``count_map`` takes any values."""
    told = df.withColumn(column, _declared(F.col(column), values, column))
    return told.groupBy(*keys).agg(*[F.count_if(F.col(column) == F.lit(v)).alias(f"{prefix}{v}") for v in values])


def count_map(df: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    """Counts of all values of a key as one map column, whatever values there are. Rows are counted before they meet, so a task holds a key's
    different values and nothing more."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(column), F.col("_n"))))).alias(name))


def list_values(df: DataFrame, keys: list[str], column: str, sep: str, name: str) -> DataFrame:
    """A delimited list column in long form: each different value of a row once."""
    parts = F.array_distinct(F.split(F.col(column), f"\\Q{sep}\\E"))
    return df.select(*keys, F.explode(parts).alias(name))


def list_flags(df: DataFrame, column: str, sep: str, values: list[str], prefix: str = "has_") -> DataFrame:
    """One boolean column for each declared value of a delimited list column; other values have none. ``list_values`` takes any."""
    parts = F.split(F.col(column), f"\\Q{sep}\\E")
    return df.select("*", *[F.coalesce(F.array_contains(parts, v), F.lit(False)).alias(f"{prefix}{v}") for v in values])


def dense_grid(df: DataFrame, name: str, values: list) -> DataFrame:
    """Every row paired with every value of a short literal list (what a small cross join is used for):
    an explode of a constant array, so no join and no shuffle."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
