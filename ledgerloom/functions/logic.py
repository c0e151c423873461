"""Conditionals, NULL rules and safe arithmetic."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def iff(cond: Column, yes, no) -> Column:
    return F.when(cond, yes).otherwise(no)


def flag(cond: Column) -> Column:
    """TRUE/FALSE indicator: an unknown condition counts as FALSE."""
    return F.coalesce(cond, F.lit(False))


def decode(value: Column, mapping: Mapping, default=None) -> Column:
    """Small fixed code list to labels; larger lists belong in a table (see ``lookup_labels``)."""
    items = list(mapping.items())
    expr = F.when(value == F.lit(items[0][0]), F.lit(items[0][1]))
    for code, label in items[1:]:
        expr = expr.when(value == F.lit(code), F.lit(label))
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def classify(text: Column, patterns: Iterable[tuple[str, str]], default=None) -> Column:
    """First LIKE pattern that matches the lower-cased text names the class."""
    lowered = F.lower(text)
    expr = None
    for pattern, label in patterns:
        hit = lowered.like(pattern)
        expr = F.when(hit, F.lit(label)) if expr is None else expr.when(hit, F.lit(label))
    return expr.otherwise(F.lit(default))


def bucket(value: Column, edges: list[float], labels: list[str]) -> Column:
    """Ordered ranges: ``labels[i]`` holds values up to and including ``edges[i]``; the last is open."""
    expr = F.when(value <= F.lit(edges[0]), F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:]):
        expr = expr.when(value <= F.lit(edge), F.lit(label))
    return expr.when(value.isNotNull(), F.lit(labels[-1]))


def _strict(fn, cols) -> Column:
    known = reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
    return F.when(known, fn(*cols))


def least_strict(*cols: Column) -> Column:
    """Smallest value, NULL as soon as one input is NULL."""
    return _strict(F.least, cols)


def greatest_strict(*cols: Column) -> Column:
    return _strict(F.greatest, cols)


def div0(a: Column, b: Column) -> Column:
    """Division where a zero divisor gives zero."""
    return F.when(b == 0, F.lit(0.0)).otherwise(F.try_divide(a, b))


def round_int(value: Column, kind: str = "bigint") -> Column:
    """Cast to an integer by rounding half away from zero, never by cutting."""
    return F.round(value).cast(kind)


def money(value: Column, scale: int = 2) -> Column:
    """Exact decimal, so sums do not depend on the order partitions finish in."""
    return value.cast(f"decimal(18,{scale})")


def normalise_unit(value: Column, threshold: float, factor: float, digits: int = 2) -> Column:
    """Values above the threshold were entered in the smaller unit."""
    return F.round(F.when(value > threshold, value / F.lit(float(factor))).otherwise(value), digits)
