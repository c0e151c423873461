"""Query registry: key -> (plan, SQL for the same result)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.context import Context

Plan = Callable[[Context], DataFrame]
_PLANS: dict[str, Plan] = {}
_SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None, text: str = "", num: str = "", ints: str = ""):
    """Register a plan. ``text``, ``num`` and ``ints`` name the columns of ``sql`` (space separated) that
    are rendered as ISO text, DOUBLE and BIGINT, matching what ``present`` does to the Spark side."""
    def register(plan: Plan) -> Plan:
        if key in _PLANS:
            raise ValueError(f"{key} registered twice")
        _PLANS[key] = plan
        if sql is not None:
            casts = [f"CAST({c} AS {kind}) AS {c}" for names, kind in
                     ((text, "VARCHAR"), (num, "DOUBLE"), (ints, "BIGINT")) for c in names.split()]
            _SQL[key] = f"SELECT * REPLACE ({', '.join(casts)}) FROM (\n{sql.strip()}\n) q" if casts else sql.strip()
        return plan
    return register


def present(df: DataFrame) -> DataFrame:
    """Result columns as plain text, numbers and flags: dates and timestamps in ISO text (year 9999 does
    not fit every client's timestamp), decimals as DOUBLE, integers as BIGINT."""
    def shown(f: T.StructField):
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return col.cast("string").alias(f.name)
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            return col.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return col.cast("bigint").alias(f.name)
        return col
    return df.select(*[shown(f) for f in df.schema.fields])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(plan: Plan):
        return lambda spark, root: present(plan(Context(spark, root, as_of=dt.date(1998, 12, 1))))
    return {key: runner(plan) for key, plan in _PLANS.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
