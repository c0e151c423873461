"""Sites, ingestion statistics and capacity of the asset portal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.logic import money, normalise_unit
from ledgerloom.operators.joins import sk_lookup
from ledgerloom.operators.project import union_all
from ledgerloom.operators.ranks import surrogate_rank


def ingestions(stats: DataFrame, companies: DataFrame, sites: DataFrame, ms_per_second: float = 1000.0,
               bytes_per_unit: float = 1_000_000.0) -> DataFrame:
    """Daily data-source statistics per company, site and handler; stats(source_id, site_id, company_id, handler,
    day, duration_ms, size, entries), companies(company_id, company_sk), sites(site_id, site_sk)."""
    rows = sk_lookup(sk_lookup(stats, companies, "company_id", "company_id", "company_sk"), sites, "site_id", "site_id", "site_sk")
    return rows.groupBy("company_sk", "site_sk", "handler", "day").agg(
        F.count_distinct("source_id").alias("sources"), (F.sum("duration_ms").cast("double") / ms_per_second).alias("seconds"),
        (F.sum("size").cast("double") / bytes_per_unit).alias("data_size"), F.sum("entries").alias("entries"))


def site_dim(portals: dict[str, DataFrame], companies: DataFrame, countries: DataFrame, with_key: bool = True) -> DataFrame:
    """One row per site over all portals; each portal gives (site_id, site_name, company_id, country, capacity).
    Capacities above 10,000 were entered in the smaller unit."""
    rows = union_all([df.withColumn("portal", F.lit(name)) for name, df in portals.items()])
    rows = rows.withColumn("capacity", normalise_unit(F.col("capacity"), 10_000, 1000))
    rows = sk_lookup(rows, companies, "company_id", "company_id", "company_sk")
    rows = sk_lookup(rows, countries, "country", "country", "country_sk")
    return surrogate_rank(rows, ["portal", "site_id"], "site_sk") if with_key else rows


def overage(sites: DataFrame, signed: DataFrame, changed: DataFrame, companies: DataFrame, as_of: Column,
            limit: float = 200.0, hidden: str = "%internal%") -> DataFrame:
    """Signed against actual capacity and site counts per company.

    sites(company_id, capacity, created, is_live), signed(company_id, signed_sites, signed_mwp), changed(company_id)
    lists companies with a recent line-item change, companies(company_id, company_name). Sites from ``limit`` up
    count by capacity, smaller ones one by one. Overage never falls below zero."""
    cap = money(F.col("capacity"), 3)
    recent = F.col("created") > F.add_months(as_of, -1)
    actual = sites.groupBy("company_id").agg(
        (F.sum(cap).cast("double") / 1000).alias("total_capacity"),
        (F.sum(F.when(F.col("capacity") >= limit, cap).otherwise(0)).cast("double") / 1000).alias("actual_capacity"),
        F.count_if(F.col("capacity") < limit).alias("actual_sites"), F.count_if(recent).alias("sites_last_month"),
        F.count_if(recent & F.col("is_live")).alias("sites_last_month_live"),
        (F.sum(F.when(F.col("is_live"), cap).otherwise(0)).cast("double") / 1000).alias("live_capacity"))
    upsell = changed.select("company_id", F.lit(True).alias("_changed")).distinct()
    out = actual.join(signed, "company_id", "left").join(upsell, "company_id", "full").join(companies, "company_id", "left")
    sites_signed, mwp = F.coalesce("signed_sites", F.lit(0)), F.coalesce("signed_mwp", F.lit(0.0))
    out = out.where(~F.lower("company_name").like(hidden))
    return out.select(
        "company_name", "total_capacity", mwp.alias("signed_capacity"), "actual_capacity", sites_signed.alias("signed_sites"),
        "actual_sites", "live_capacity", F.round(F.greatest(F.col("actual_capacity") - mwp, F.lit(0.0)), 3).alias("capacity_over"),
        F.greatest(F.col("actual_sites") - sites_signed, F.lit(0)).alias("sites_over"),
        F.coalesce(F.col("signed_sites").isNotNull(), F.lit(False)).alias("active_deal"), "sites_last_month",
        "sites_last_month_live", F.coalesce("_changed", F.lit(False)).alias("line_item_change"))


def country_dim(codes: DataFrame, shapes: DataFrame, key: str, with_key: bool = True) -> DataFrame:
    """Country codes full-joined to shapes; shapes without a code get ids from 1000 on. codes(<key>, country_id,
    name), shapes(<key>, shape_name)."""
    merged = codes.join(shapes, key, "full")
    known = merged.where("country_id IS NOT NULL")
    extra = merged.where("country_id IS NULL")
    extra = surrogate_rank(extra, ["shape_name"], "_rank", parts=2).withColumn("country_id", F.col("_rank") + 1000).drop("_rank")
    out = known.unionByName(extra.select(*known.columns)) if with_key else merged
    return out.withColumn("name", F.coalesce("name", "shape_name"))
