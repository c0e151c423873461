"""JSON paths, arrays and delimited lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Associations arrive as JSON arrays of objects with these two fields.
ASSOCIATIONS = "array<struct<id:string,type:string>>"


def json_path(text: Column, path: str, kind: str = "string") -> Column:
    return F.get_json_object(text, "$." + path).try_cast(kind)


def parse_json(text: Column, schema: str) -> Column:
    """Declared schema instead of paths: parsed once, columnar and prunable afterwards."""
    return F.from_json(text, schema)


def variant_path(text: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.try_parse_json(text), "$." + path, kind)


def associations(text: Column) -> Column:
    """Parsed association array. None at all, and one of plain id and type written without spaces, are cut out of the text: starting the
    JSON parser for each row took most of the time of scans with several such columns."""
    part = F.split(text, '"')
    one = F.array(F.struct(part[3].alias("id"), part[7].alias("type")))
    return (F.when(text == "[]", F.from_json(F.lit("[]"), ASSOCIATIONS)).when(text.rlike(r'\A\[\{"id":"[0-9A-Za-z_]*","type":"[0-9A-Za-z_]*"\}\]\z'), one)
            .otherwise(F.from_json(text, ASSOCIATIONS)))


def ids_of(assoc: Column, kind: str | None = None) -> Column:
    """Ids of an association array, optionally of one type only, sorted."""
    kept = F.filter(assoc, lambda a: a["type"] == kind) if kind else assoc
    return F.array_sort(F.transform(kept, lambda a: a["id"].cast("bigint")))


def at(arr: Column, i: int) -> Column:
    return F.get(arr, F.lit(i))


def size0(arr: Column) -> Column:
    """Length of an array, 0 for NULL."""
    return F.coalesce(F.array_size(arr), F.lit(0))


def list_contains(text: Column, sep: str, value: str) -> Column:
    return F.array_contains(F.split(text, f"\\Q{sep}\\E"), value)
