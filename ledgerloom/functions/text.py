"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def empty_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def typed(value: Column, kind: str) -> Column:
    """Raw text to a type: '' is NULL, text that does not parse is NULL."""
    return empty_to_null(value.cast("string")).try_cast(kind)


def remove(value: Column, part: str) -> Column:
    return F.replace(value, F.lit(part), F.lit(""))


def strip_left(value: Column, n: int) -> Column:
    return F.substring(value, F.lit(n + 1), F.length(value))


def split_part(value: Column, sep: str, n: int) -> Column:
    return F.split_part(value, F.lit(sep), F.lit(n))


def concat_strict(*cols: Column) -> Column:
    """NULL if any part is NULL."""
    return F.concat(*cols)


def regex_full(value: Column, pattern: str) -> Column:
    return value.rlike(f"^(?:{pattern})$")


def norm_name(value: Column) -> Column:
    return F.lower(F.trim(value))


def pseudonymise(ident: Column, user: Column, staff: Column, domain: str) -> Column:
    """Staff keep the local part of their login, everybody else becomes ``id@domain``."""
    return F.when(staff, F.split_part(user, F.lit("@"), F.lit(1))).otherwise(
        F.concat(ident.cast("string"), F.lit("@" + domain)))


def seq_label(order: Column, label: Column) -> Column:
    """Display position 0, 1, 2 .. becomes the prefix (a), (b), (c) .."""
    return F.concat(F.lit("("), F.char(F.lit(97) + order), F.lit(") "), label)
