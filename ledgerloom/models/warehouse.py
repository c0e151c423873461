"""Model registry and the object models read from."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.context import discard, new_folder, run_once, tune
from ledgerloom.operators import quality
from ledgerloom.operators.project import union_all
from ledgerloom.sources.incremental import incremental_append


@dataclass
class Rules:
    """Business settings the models read; everything site-specific is here and not in the models."""

    own_domain: str = "example.com"
    deal_pipelines: tuple[str, ...] = ("default",)
    product_categories: dict[int, str] = field(default_factory=dict)
    renamed_people: dict[str, str] = field(default_factory=dict)
    departments: dict[str, str] = field(default_factory=dict)
    account_categories: dict[int, str] = field(default_factory=dict)
    cost_centres: dict[int, str] = field(default_factory=dict)
    country_fixes: dict[str, int] = field(default_factory=dict)
    payroll_contacts: tuple[str, ...] = ("Salary", "Salary tax / social security")
    own_company_ids: tuple[int, ...] = ()
    smart_meter_types: tuple[str, ...] = ("meter",)
    sources_as_sum: bool = False   # a company's sources of a month: the sum of daily numbers instead of different ones
    domestic_country: str = "Germany"
    quiet_ticket_stages: tuple[str, ...] = ("Closed", "Archived")
    service_hours: dict[str, tuple[int, int]] = field(default_factory=lambda: {"Partner": (8, 17), "Support": (10, 16)})
    tz: str = "Europe/Berlin"
    ticket_hours_as_minutes: bool = False   # read a ticket's hours as minutes, as one source system's report does


Model = Callable[["Warehouse"], DataFrame | Iterator[DataFrame]]
MODELS: dict[str, tuple[Model, str]] = {}


def model(name: str, kind: str = "view"):
    """``kind`` is 'table' for models worth storing and 'view' for the others; see ``incremental`` for the third kind. A table model may
    yield its rows in parts, which are written one after another: what making one part takes on disk is free again for the next."""
    def register(fn: Model) -> Model:
        if name in MODELS:
            raise ValueError(f"model {name} exists")
        MODELS[name] = (fn, kind)
        return fn
    return register


@dataclass(frozen=True)
class Load:
    """What an incremental model reads: a relation, its time column, and the day column of its own rows."""

    group: str
    table: str
    ts: str
    day: str


LOADS: dict[str, Load] = {}


def incremental(name: str, group: str, table: str, ts: str, day: str):
    """A model that keeps its rows between runs and reads only days after the newest it has. ``fn(wh, rows)`` builds its rows from
    those new ones; it must not mix days."""
    def register(fn: Callable[["Warehouse", DataFrame], DataFrame]):
        model(name, "incremental")(fn)
        LOADS[name] = Load(group, table, ts, day)
        return fn
    return register


ROW_CHECKS: dict[str, list[quality.Rule]] = {}
PASS_ROWS = "spark.ledgerloom.passRows"   # rows that are joined in one pass, as long as ``MOST_PASSES`` are enough for it
MOST_PASSES = 8


class Warehouse:
    """Resolves sources, snapshots and other models. ``source(group, table)`` returns raw relations;
    snapshots are row histories with ``valid_from`` / ``valid_to`` (NULL while open)."""

    def __init__(self, spark: SparkSession, source: Callable[[str, str], DataFrame], snapshots: dict[str, DataFrame],
                 as_of: dt.date, rules: Rules | None = None, store_tables: bool = True, state: str | None = None):
        """``state`` is the folder in which incremental models keep their rows between runs; without one they load everything."""
        self.spark, self._source, self._snapshots = tune(spark), source, snapshots
        self.as_of, self.rules, self._store = as_of, rules or Rules(), store_tables
        self._state = state or new_folder(spark, "warehouse-state")
        self._done: dict[str, DataFrame] = {}
        self._parts: dict[str, list[DataFrame]] = {}
        self.verdicts: dict[str, dict[str, tuple[int, str]]] = {}   # of the row checks of table models, counted while they were written

    def source(self, group: str, table: str) -> DataFrame:
        return self._source(group, table)

    def snapshot(self, name: str) -> DataFrame:
        return self._snapshots[name]

    @property
    def today(self):
        return F.lit(self.as_of)

    def ref(self, name: str) -> DataFrame:
        """A model's rows. With ``store_tables`` the table models are written once and read back, so that
        what several models share is computed once and survives lost executors."""
        if name not in self._done:
            fn, kind = MODELS[name]
            if kind == "incremental":
                load = LOADS[name]
                df = incremental_append(self.source(load.group, load.table), os.path.join(self._state, name), load.ts, load.day, lambda rows: fn(self, rows))
            else:
                df = fn(self)
            if kind == "table":
                parts = df if isinstance(df, Iterator) else iter([df])
                if self._store:
                    paths = [self._written(name, part) for part in parts]
                    self._parts[name], df = [self.spark.read.parquet(p) for p in paths], self.spark.read.parquet(*paths)
                else:
                    self._parts[name] = list(parts)
                    df = union_all(self._parts[name])
            self._done[name] = df
        return self._done[name]

    def _written(self, name: str, df: DataFrame) -> str:
        """Where a part of a table model was written; what its row checks find is added to that of the parts before."""
        path, rules = new_folder(self.spark, name), ROW_CHECKS.get(name)
        rows, seen = quality.observed(df, rules) if rules else (df, None)
        with run_once(self.spark):
            rows.write.option("compression", "zstd").parquet(path)
        if seen is not None:
            before, found = self.verdicts.get(name, {}), quality.verdicts(seen, rules)
            self.verdicts[name] = {k: (n + before[k][0], verdict if n else before[k][1]) if k in before else (n, verdict) for k, (n, verdict) in found.items()}
        return path

    def parts(self, name: str) -> list[DataFrame]:
        """A table model's rows in the parts it was made in."""
        self.ref(name)
        return self._parts[name]

    def in_passes(self, rows: DataFrame, key: str, name: str) -> Iterator[tuple[DataFrame, Callable[[DataFrame, str], DataFrame]]]:
        """``rows`` in as many passes as their number asks for, by a hash of ``key``, and with each a function that cuts another frame's rows
        in the same way. Many rows are written before the first pass, and those of a pass are deleted after it. Without
        ``store_tables`` there is one pass."""
        n = min(MOST_PASSES, -(-rows.count() // int(self.spark.conf.get(PASS_ROWS, "4000000")))) if self._store else 1
        if n < 2:
            yield rows, lambda df, column: df
            return
        of = lambda column: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
        path, cut = new_folder(self.spark, name), rows.withColumn("_pass", of(key))
        with run_once(self.spark):
            cut.write.option("compression", "zstd").partitionBy("_pass").parquet(path)
        for k in range(n):
            some = self.spark.read.schema(cut.schema).parquet(path).where(F.col("_pass") == k).drop("_pass")
            yield some, lambda df, column, k=k: df.where(of(column) == k)
            discard(self.spark, os.path.join(path, f"_pass={k}"))
        discard(self.spark, path)
