"""Associations, pipelines, feature requests and other CRM shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.logic import classify
from ledgerloom.operators.ordered import first_per_key, with_totals
from ledgerloom.operators.project import union_all
from ledgerloom.operators.ranks import surrogate_rank


def bridge(df: DataFrame, key: str, arrays: dict[str, str]) -> DataFrame:
    """n:m links in long form; ``arrays`` maps an object type to the array column with its ids."""
    return union_all([df.select(key, F.lit(kind).alias("object_type"), F.explode(F.col(col).cast("array<bigint>")).alias("object_id"))
                      for kind, col in arrays.items()])


def pair_companies(pairs: DataFrame, deal_company: DataFrame) -> DataFrame:
    """Every deal of an engagement meets every company; keep the pairs where the company is the deal's own
    or one of the two is unknown. pairs(event_id, deal_id, company_id), deal_company(deal_id, company_id)."""
    own = deal_company.select("deal_id", F.col("company_id").alias("_own")).distinct()
    out = pairs.join(own, "deal_id", "left")
    keep = ((F.col("company_id") == F.col("_own")) | F.col("_own").isNull() | F.col("company_id").isNull())
    out = out.where(keep & (F.col("deal_id").isNotNull() | F.col("company_id").isNotNull()))
    out = out.withColumn("company_id", F.coalesce("company_id", "_own")).drop("_own")
    return with_totals(out, ["event_id"], F.count_distinct("deal_id").alias("num_deals"),
                       F.count_distinct("company_id").alias("num_companies"))


def multi_parent(links: DataFrame, child: str, parent: str) -> DataFrame:
    """Children linked to more than one parent, with the number of links."""
    counts = links.groupBy(child).agg(F.count(F.lit(1)).alias("parents")).where("parents > 1")
    return links.join(counts, child).select(child, parent, "parents")


def feature_requests(df: DataFrame, keys: list[str], lists: dict[str, str], labels: DataFrame, sep: str = ";",
                     group_sep: str = " - ") -> DataFrame:
    """Delimited request lists to one row per request.

    ``lists`` maps a need type to its list column, ``labels`` is (value, latest label). A label reads
    'group - name'; names ending in 'other' are free-text placeholders."""
    rows = union_all([df.where(F.col(col).isNotNull()).select(
        *keys, F.explode(F.split(F.col(col), f"\\Q{sep}\\E")).alias("_value"), F.lit(need).alias("need_type"))
        for need, col in lists.items()])
    names = labels.select(F.col(labels.columns[0]).alias("_v"), F.col(labels.columns[1]).alias("_label"))
    rows = rows.join(names, F.col("_value") == F.col("_v"), "left")
    rows = rows.withColumn("feature", F.coalesce("_label", "_value")).drop("_value", "_v", "_label")
    group = F.split_part("feature", F.lit(group_sep), F.lit(1))
    return (rows.withColumn("feature_group", group)
            .withColumn("feature_name", F.trim(F.substring(F.col("feature"), F.length(group) + len(group_sep) + 1, F.length("feature"))))
            .withColumn("description_type", F.when(F.lower("feature").like(f"%{group_sep}other"), "other").otherwise("standard")))


def pipeline_dim(pipelines: DataFrame, ladder: list[tuple[str, str]], default: str = "Other", with_key: bool = True) -> DataFrame:
    """Stages of nested pipelines; pipelines(pipeline_id, label, seen_at, stages array of struct(id, label,
    display_order, probability)). The latest version of a stage counts; probability 1 means won."""
    flat = pipelines.select("pipeline_id", F.col("label").alias("pipeline_label"), "seen_at", F.explode("stages").alias("s"))
    flat = flat.select("pipeline_id", "pipeline_label", "seen_at", F.col("s.id").alias("stage_id"), F.col("s.label").alias("stage_label"),
                       F.col("s.display_order").alias("display_order"), F.col("s.probability").alias("probability"))
    latest = first_per_key(flat, ["pipeline_id", "stage_id"], [F.col("seen_at").desc_nulls_last()])
    out = latest.withColumn("stage_name", classify(F.col("stage_label"), ladder, default)).withColumn(
        "is_won", F.coalesce(F.col("probability") == 1, F.lit(False)))
    return surrogate_rank(out, ["pipeline_id", "display_order"], "stage_sk") if with_key else out


def feedback(answers: DataFrame, users: DataFrame, key: str, kinds: dict[str, str]) -> DataFrame:
    """Sum and count of survey results per user and survey; answers(<key>, survey, result). ``kinds`` maps a
    column prefix to the survey type."""
    aggs: list[Column] = []
    for name, survey in kinds.items():
        hit = F.when(F.col("survey") == survey, F.col("result"))
        aggs += [F.sum(hit).alias(name + "_sum"), F.count(hit).alias(name + "_count")]
    return users.join(answers.groupBy(key).agg(*aggs), key, "left")
