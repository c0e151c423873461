"""One entity from the records of several systems: identity keys, transitive links, names last, and the merged row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.context import checkpointed
from ledgerloom.operators.graph import components
from ledgerloom.operators.ranks import surrogate_rank


def _has_value(column: str) -> Column:
    return F.col(column).isNotNull() & (F.btrim(F.col(column).cast("string")) != "")


def _strong(records: DataFrame, keys: list[str]) -> DataFrame:
    """Entity of every node by keys that prove identity: equal values, across all keys and transitively."""
    held = None
    for key in keys:
        one = records.where(_has_value(key)).select(F.lit(key).alias("_kind"), F.col(key).cast("string").alias("_value"), "_node").distinct()
        held = one if held is None else held.unionByName(one)
    if held is None:
        return records.select("_node", F.col("_node").alias("_entity")).distinct()
    least = checkpointed(held.groupBy("_kind", "_value").agg(F.min("_node").alias("_least"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    links = held.join(least, ["_kind", "_value"]).select(F.col("_node").alias("a"), F.col("_least").alias("b"))
    return _renamed(records.select("_node").distinct(), "_node", components(links))


def _renamed(df: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    out = df.join(roots.withColumnsRenamed({"v": "_v", "root": "_root"}), F.col(column) == F.col("_v"), "left")
    return out.withColumn("_entity", F.coalesce("_root", column)).drop("_v", "_root")


def _weak(records: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """New entity of every entity by a key that may be shared by chance, and the values that could not be used. ``records`` has _entity."""
    systems = checkpointed(records.select("_entity", "_system").distinct())
    held = checkpointed(records.where(_has_value(key)).select(F.col(key).cast("string").alias("_value"), "_entity").distinct())
    per_system = held.join(systems, "_entity").groupBy("_value", "_system").agg(F.count(F.lit(1)).alias("_n"))
    clear = per_system.groupBy("_value").agg(F.max("_n").alias("_most"))
    sizes = held.groupBy("_value").agg(F.count(F.lit(1)).alias("_n"), F.min("_entity").alias("_least")).where("_n > 1")
    shared = checkpointed(sizes.join(clear, "_value"))
    links = held.join(shared.where("_most = 1"), "_value").select(F.col("_entity").alias("a"), F.col("_least").alias("b"))
    named = checkpointed(_renamed(systems.withColumnRenamed("_entity", "_old"), "_old", components(links)))
    double = named.groupBy("_entity", "_system").agg(F.count_distinct("_old").alias("_n")).where("_n > 1").select(F.col("_entity").alias("_bad")).distinct()
    new = named.select("_old", "_entity").distinct().join(checkpointed(double), F.col("_entity") == F.col("_bad"), "left")
    return (new.select("_old", F.when(F.col("_bad").isNull(), F.col("_entity")).otherwise(F.col("_old")).alias("_entity")),
            shared.where("_most > 1").select("_value"))


def resolve_identities(records: DataFrame, systems: list[str], strong: list[str], weak: list[str] = ()) -> DataFrame:
    """``records`` (system, record_id, key columns, others) with the entity each belongs to: entity_system and entity_id name the entity's first
    record, in the order of ``systems``, then by record_id.

    Equal values of a ``strong`` key - an id that another system holds, an e-mail address - mean one entity, transitively across all
    of them. ``weak`` keys - names - are tried in turn, between the entities found so far. A value links entities only if no two
    of them have records of the same system: a name that one system uses twice identifies nobody there. If links of several
    values together would join two entities of one system, none of them holds. ``ambiguous`` marks records with a weak value that
    was not used for the first reason. Null and blank values are no values; keys are compared as they stand, so normalise them first.
    Records of one system and id are one record. A system that is not listed comes last. Columns named ``_node``, ``_entity``, ``_old``,
    ``_system``, ``_order`` or like one of the results are replaced."""
    order = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(s) for s in systems]), F.col("system")), F.lit(0)), F.lit(len(systems) + 1))
    free = records.drop("_node", "_entity", "_old", "entity_system", "entity_id", "ambiguous")
    rows = free.withColumn("_order", order).withColumn("_system", F.col("system"))
    base = checkpointed(surrogate_rank(rows, ["_order", "system", "record_id"], "_node"))
    entities = checkpointed(_strong(base, strong))
    out = base.join(entities, "_node").withColumn("ambiguous", F.lit(False))
    for key in weak:
        out = checkpointed(out)
        new, unused = _weak(out, key)
        out = out.withColumnRenamed("_entity", "_old").join(new, "_old").drop("_old")
        out = out.join(unused.withColumnRenamed("_value", "_unused"), F.col(key).cast("string") == F.col("_unused"), "left")
        out = out.withColumn("ambiguous", F.col("ambiguous") | F.col("_unused").isNotNull()).drop("_unused")
    names = base.select(F.col("_node").alias("_entity"), F.col("system").alias("entity_system"), F.col("record_id").alias("entity_id")).distinct()
    return checkpointed(out).join(names, "_entity").drop("_entity", "_node", "_order", "_system")


def merged_entities(resolved: DataFrame, systems: list[str], attributes: list[str]) -> DataFrame:
    """One row for each entity of ``resolve_identities``: each attribute from the first system that has it, for each system whether the entity
    is in it and its least id there, and the number of records."""
    at = F.struct(F.array_position(F.array(*[F.lit(s) for s in systems]), F.col("system")), F.col("record_id"))
    values = [F.min_by(a, F.when(F.col(a).isNotNull(), at)).alias(a) for a in attributes]
    inside = [F.min(F.when(F.col("system") == s, F.col("record_id"))).alias(f"{s}_id") for s in systems]
    present = [F.bool_or(F.col("system") == s).alias(f"in_{s}") for s in systems]
    return resolved.groupBy("entity_system", "entity_id").agg(*values, *inside, *present, F.count(F.lit(1)).alias("n_records"))
