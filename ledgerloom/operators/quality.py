"""Data checks. Each returns the failing rows: an empty result is a pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.functions.dates import boundary_diff
from ledgerloom.operators.ordered import HotKeys, neighbours


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, *key: Column, where: Column | None = None) -> DataFrame:
    """Key values that occur more than once among the rows of ``where``."""
    rows = df if where is None else df.where(where)
    named = [k.alias(f"key{i}") for i, k in enumerate(key)]
    out = rows.select(*named)
    for i in range(len(key)):
        out = out.where(F.col(f"key{i}").isNotNull())
    return out.groupBy(*[f"key{i}" for i in range(len(key))]).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def row_count(df: DataFrame, column: str, above: int) -> DataFrame:
    """Fails when fewer than ``above`` values are present."""
    return df.agg(F.count(column).alias("row_count")).where(F.col("row_count") < above)


def valid_range(df: DataFrame, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    low = F.coalesce(F.col(start).cast("date"), F.expr("DATE'0001-01-01'"))
    high = F.coalesce(F.col(end).cast("date"), F.expr("DATE'9999-12-31'"))
    both_set = F.col(start).isNotNull() & F.col(end).isNotNull()
    return df.where(F.when(both_set, F.col(start) > F.col(end)).otherwise(low > high))


def _with_previous_end(df: DataFrame, key: str, start: str, end: str, hot: HotKeys | None) -> DataFrame:
    rows = df.where(F.col(key).isNotNull())
    return neighbours(rows, [key], [end, start], hot, previous={"previous_to": end})


def date_gaps(df: DataFrame, key: str, hot: HotKeys | None, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Consecutive versions that do not meet on the same day."""
    out = _with_previous_end(df, key, start, end, hot)
    out = out.withColumn("day_difference", F.date_diff(F.col(start).cast("date"), F.col("previous_to").cast("date")))
    return out.where("day_difference <> 0")


def time_gaps(df: DataFrame, key: str, hot: HotKeys | None, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Consecutive versions that do not meet in the same minute."""
    out = _with_previous_end(df, key, start, end, hot)
    out = out.withColumn("minute_difference", boundary_diff("minute", F.col(start), F.col("previous_to")))
    return out.where("minute_difference <> 0")


def single_active(df: DataFrame, key: str, active: Column) -> DataFrame:
    """Keys with no or several active versions."""
    return df.groupBy(key).agg(F.count_if(active).alias("active_versions")).where("active_versions <> 1")


def pair_gt(df: DataFrame, a: str, b: str, or_equal: bool = False) -> DataFrame:
    holds = (F.col(a) >= F.col(b)) if or_equal else (F.col(a) > F.col(b))
    return df.where(~holds)


def sum_between(df: DataFrame, column: Column, low: float, high: float, by: list[str], where: Column | None = None,
                strict: bool = False) -> DataFrame:
    """Groups whose sum leaves the range."""
    rows = df if where is None else df.where(where)
    sums = rows.groupBy(*by).agg(F.sum(column).alias("total"))
    total = F.col("total")
    inside = ((total > low) & (total < high)) if strict else ((total >= low) & (total <= high))
    return sums.where(~inside)


def length_between(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    return df.where(~F.length(column).between(low, high))


def relationship(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-NULL foreign key has no parent."""
    keys = parent.select(F.col(parent_column).alias("_k"))
    return df.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_k"), "left_anti")


def accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(~F.col(column).isin(*values))


def expression_true(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(~condition)


def dup_names(df: DataFrame, name: str, measure: Column) -> DataFrame:
    """Names shared by several entities with a positive measure: a name join would duplicate them."""
    return df.where(measure > 0).groupBy(name).agg(F.count(name).alias("n")).where("n > 1")


@dataclass(frozen=True)
class Rule:
    """A check that a row passes or fails by itself. ``fails`` is the failing condition as SQL text, so that rules can be stated where
    there is no session yet; NULL is no failure."""

    name: str
    fails: str
    severity: str = "error"


def is_set(column: str, severity: str = "error") -> Rule:
    return Rule(f"{column} is set", f"`{column}` IS NULL", severity)


def is_one_of(column: str, values: list[str], severity: str = "error") -> Rule:
    told = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return Rule(f"{column} is known", f"`{column}` NOT IN ({told})", severity)


def holds(name: str, condition: str, severity: str = "error") -> Rule:
    return Rule(name, f"NOT ({condition})", severity)


def _counts(rules: list[Rule]) -> list[Column]:
    return [F.count_if(F.expr(r.fails)).alias(f"check_{i}") for i, r in enumerate(rules)]


def _verdict(failing: Column, severity: Column) -> Column:
    return F.when(failing == 0, "pass").otherwise(F.when(severity == "warn", "warn").otherwise("fail"))


def row_summary(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule, as ``summary`` gives it, from one scan of the table and one aggregate for all rules."""
    told = F.array(*[F.struct(F.lit(r.name).alias("check"), F.lit(r.severity).alias("severity"), F.col(f"check_{i}").alias("failing")) for i, r in enumerate(rules)])
    out = df.agg(*_counts(rules)).select(F.explode(told).alias("c")).select("c.*")
    return out.withColumn("verdict", _verdict(F.col("failing"), F.col("severity")))


def observed(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, Observation]:
    """``df`` that counts its failing rows while it is written: no scan of its own. ``verdicts`` reads the counts afterwards."""
    seen = Observation()
    return df.observe(seen, *_counts(rules)), seen


def verdicts(seen: Observation, rules: list[Rule]) -> dict[str, tuple[int, str]]:
    """Failing rows and verdict of each rule, once the observed rows are written."""
    counts = seen.get
    failed = lambda r: "warn" if r.severity == "warn" else "fail"
    return {r.name: (n, "pass" if n == 0 else failed(r)) for i, r in enumerate(rules) for n in [counts[f"check_{i}"]]}


def failing_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows that fail any rule, with the names of the rules they fail. Only for looking into a failure."""
    names = F.filter(F.array(*[F.when(F.expr(r.fails), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    return df.withColumn("failed", names).where(F.size("failed") > 0)


def summary(checks: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per check: failing rows, severity, verdict. ``checks``: name -> (failing rows, severity). For checks that need more
    than a row; see ``row_summary`` for those that do not."""
    parts = []
    for name, (failing, severity) in checks.items():
        parts.append(failing.agg(F.count(F.lit(1)).alias("failing")).select(
            F.lit(name).alias("check"), F.lit(severity).alias("severity"), "failing"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("verdict", _verdict(F.col("failing"), F.col("severity")))
