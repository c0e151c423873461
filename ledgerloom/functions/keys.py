"""Fingerprints and change detection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def surrogate_md5(*cols: Column) -> Column:
    """MD5 over the text of all columns joined by '-'; NULL counts as empty text."""
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def differs(a: list[Column], b: list[Column]) -> Column:
    """NULL-safe inequality of two column lists."""
    return ~F.struct(*a).eqNullSafe(F.struct(*b))


def changed(cols: list[Column], w: WindowSpec) -> Column:
    """Row differs from its predecessor; compares values, so NULLs cannot collide as in a hash."""
    row = F.struct(*cols)
    return ~row.eqNullSafe(F.lag(row).over(w))
