"""Asset portal: companies, users, sites, data sources, usage and cloud cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import clean_date, day, month_first, recency
from ledgerloom.functions.geo import clean_coordinate
from ledgerloom.functions.logic import flag, money
from ledgerloom.functions.nested import json_path
from ledgerloom.functions.text import empty_to_null, norm_name, pseudonymise, split_part, typed
from ledgerloom.models.warehouse import Warehouse, incremental, model
from ledgerloom.operators import crm as crm_ops
from ledgerloom.operators import joins, portal
from ledgerloom.operators.aggregate import listagg_distinct
from ledgerloom.operators.distinct import count_states, dense_ids, distinct_states, merged_states
from ledgerloom.operators.ordered import first_per_key
from ledgerloom.operators.project import count_map, with_unknown
from ledgerloom.operators.ranks import surrogate_rank
from ledgerloom.sources.build import latest_batch

c = F.col

# Earliest plausible installation date and the date the portal writes for 'never'.
DATE_FLOOR, NEVER = "2006-01-01", "0001-01-01"
ENGLISH = "en"


@model("staging_countries", "table")
def staging_countries(wh: Warehouse) -> DataFrame:
    """Country codes with shapes, in all languages; shapes without a code get ids from 1000 on."""
    codes = wh.source("files", "countries").select(c("alpha3"), typed(c("id"), "bigint").alias("country_id"), c("name"), c("language"))
    shapes = wh.source("files", "geographies").select("alpha3", c("name").alias("shape_name"), "ring")
    return portal.country_dim(codes, shapes, "alpha3")


@model("dim_country")
def dim_country(wh: Warehouse) -> DataFrame:
    rows = wh.ref("staging_countries").where(c("language").isNull() | (c("language") == ENGLISH)).select("country_id", "name", "alpha3")
    return with_unknown(surrogate_rank(rows, ["country_id"], "country_sk"), {"country_id": -1, "country_sk": -1, "name": "UNKNOWN"})


@model("staging_portal_companies")
def staging_portal_companies(wh: Warehouse) -> DataFrame:
    return wh.source("portal", "company").select(
        c("id").alias("portal_company_id"), c("name").alias("company_name"), c("status").alias("account_type"),
        clean_date(c("created_at"), sentinel=NEVER).alias("create_date"), typed(c("company_code"), "bigint").alias("crm_company_id"))


@model("staging_portal_users")
def staging_portal_users(wh: Warehouse) -> DataFrame:
    """Portal users under a handle instead of their login."""
    staff = flag(c("email").like("%" + wh.rules.own_domain))
    domain = F.split_part("email", F.lit("@"), F.lit(2))
    handle = F.when(staff, pseudonymise(c("id"), c("email"), staff, "")).otherwise(F.concat(c("id").cast("string"), F.lit("@"), domain))
    return wh.source("portal", "user").select(
        c("id").alias("portal_user_id"), handle.alias("username"), c("customer_id").alias("portal_company_id"), "email", c("is_blocked"),
        day(c("created_at")).alias("created_at"), day(c("last_login")).alias("last_login"), staff.alias("is_staff"))


@model("staging_crm_contacts", "table")
def staging_crm_contacts(wh: Warehouse) -> DataFrame:
    """CRM contacts and portal users matched by e-mail."""
    crm = wh.source("crm_activity", "contacts").where("NOT archived").select(
        typed(c("id"), "bigint").alias("crm_contact_id"), typed(c("company_id"), "bigint").alias("company_id"), "email", "job_title", "language", "country")
    users = wh.ref("staging_portal_users").withColumnRenamed("email", "_email")
    out = crm.join(users, c("email") == c("_email"), "full")
    staff = flag(F.coalesce("_email", "email").like("%" + wh.rules.own_domain))
    return out.withColumn("is_staff", staff).drop("email", "_email").distinct()


@model("dim_user", "table")
def dim_user(wh: Warehouse) -> DataFrame:
    """Contacts and portal users with survey scores and both company keys."""
    answers = wh.source("crm", "feedback_submissions").select(typed(c("contact_id"), "bigint").alias("crm_contact_id"), c("survey"),
                                                               typed(c("result"), "int").alias("result"))
    out = crm_ops.feedback(answers, wh.ref("staging_crm_contacts"), "crm_contact_id", {"faq": "Frequently asked questions", "effort": "Customer effort score"})
    out = joins.sk_lookup(out, wh.ref("dim_company").where("company_id IS NOT NULL"), "company_id", "company_id", "company_sk")
    second = wh.ref("portal_company_keys").select("portal_company_id", c("company_sk").alias("portal_company_sk"))
    out = joins.sk_lookup(out, second, "portal_company_id", "portal_company_id", "portal_company_sk")
    out = out.withColumn("_key", F.coalesce(c("crm_contact_id").cast("string"), F.concat(c("portal_user_id").cast("string"), F.lit("ID"))))
    return surrogate_rank(out, ["_key"], "user_sk").drop("_key")


@model("staging_sites", "table")
def staging_sites(wh: Warehouse) -> DataFrame:
    """Portal sites with their country: by position, else by name, else by a list of fixes, else -1."""
    address = wh.source("portal", "address").select(c("id").alias("address_id"), clean_coordinate(typed(c("latitude"), "double")).alias("lat"),
                                                    clean_coordinate(typed(c("longitude"), "double")).alias("lon"), F.lower(F.trim("country")).alias("_country"))
    metrics = wh.source("portal_metrics", "site").select("site_id", c("last_contact").cast("timestamp_ntz").alias("last_contact"))
    sites = wh.source("portal", "site").where("type <> 'Subsite'").select(
        "site_id", c("name").alias("site_name"), c("customer_id").alias("portal_company_id"), typed(c("capacity"), "double").alias("capacity"), "address_id",
        clean_date(c("installed_at"), floor=DATE_FLOOR).alias("installation_date"), clean_date(c("created_at"), floor=DATE_FLOOR).alias("create_date"))
    sites = sites.join(metrics, "site_id", "left").join(address, "address_id", "left")
    countries = wh.ref("staging_countries")
    areas = countries.where(c("ring").isNotNull() & (c("language").isNull() | (c("language") == ENGLISH))).select("country_id", "ring")
    located = joins.point_in_polygon(sites.where("lat IS NOT NULL AND lon IS NOT NULL").select("site_id", "lon", "lat"), areas, "lon", "lat", "ring")
    located = located.groupBy("site_id").agg(F.min("country_id").alias("v"))
    named = countries.where("name IS NOT NULL").groupBy(F.lower("name").alias("k")).agg(F.min("country_id").alias("v"))
    lookups = [(c("site_id"), located), (c("_country"), named)]
    if wh.rules.country_fixes:
        lookups.append((c("_country"), wh.spark.createDataFrame(list(wh.rules.country_fixes.items()), "k string, v bigint")))
    out = joins.first_match(sites, lookups, "country_id", -1).drop("_country", "address_id")
    return out.withColumn("status", recency(c("last_contact"), wh.today)).withColumn("is_live", flag(c("status") == "Active"))


@model("staging_datasources", "table")
def staging_datasources(wh: Warehouse) -> DataFrame:
    """Data sources with device counts per type found in the data and the handlers that fed them."""
    events = wh.source("portal_events", "data_source_event")
    fed = events.groupBy("data_source_id").agg(F.max("entry_date").alias("last_ingestion")).join(
        listagg_distinct(events, ["data_source_id"], "data_handler", ";", "handlers"), "data_source_id")
    devices = wh.source("portal", "device").where("physical_device_id IS NULL").select("data_source_id", c("type").alias("device_type"))
    counts = count_map(devices, ["data_source_id"], "device_type", "devices")
    kinds = listagg_distinct(devices, ["data_source_id"], "device_type", ";", "device_types").join(devices.groupBy("data_source_id").agg(
        F.count(F.lit(1)).alias("n_devices"), F.bool_or(c("device_type").isin(*wh.rules.smart_meter_types)).alias("has_smart_meter")), "data_source_id")
    live = wh.source("portal", "datasource").where("lower(status) <> 'inactive' AND deleted_at IS NULL").select(
        "data_source_id", "site_id", clean_date(c("created_at"), floor=DATE_FLOOR).alias("create_date"))
    out = live.join(counts, "data_source_id").join(kinds, "data_source_id").join(fed, "data_source_id", "left")
    return out.withColumn("status", recency(c("last_ingestion"), wh.today))


@model("staging_datasource_events", "table")
def staging_datasource_events(wh: Warehouse) -> DataFrame:
    """Daily statistics of data sources with site and company."""
    places = wh.source("portal", "datasource").select("data_source_id", "site_id").join(
        wh.source("portal", "site").select("site_id", c("customer_id").alias("company_id")), "site_id", "left")
    return wh.source("portal_events", "data_source_event").join(places, "data_source_id", "left").select(
        c("data_source_id").alias("source_id"), "site_id", "company_id", c("data_handler").alias("handler"), day(c("entry_date")).alias("day"),
        money(c("duration_ms")).alias("duration_ms"), money(c("data_size")).alias("size"), c("count_entries").alias("entries"))


def _file_portal(wh: Warehouse, table: str) -> DataFrame:
    """Sites of a portal that is known from files: the last row of each site, its country by name."""
    rows = first_per_key(wh.source("files", table), ["site_id"], [c("updated").desc_nulls_last()])
    names = wh.ref("staging_countries").where("name IS NOT NULL").groupBy(F.lower("name").alias("_name")).agg(F.min("country_id").alias("country"))
    out = rows.join(names, F.lower(F.trim("country_name")) == c("_name"), "left")
    return out.select("site_id", "site_name", "company_name", F.coalesce("country", F.lit(-1)).alias("country"), typed(c("capacity"), "double").alias("capacity"),
                      F.lit(DATE_FLOOR).cast("date").alias("create_date"), recency(c("updated"), wh.today).alias("status"), F.lit(False).alias("is_live"),
                      typed(c("devices"), "bigint").alias("n_devices"))


@model("staging_first_portal", "table")
def staging_first_portal(wh: Warehouse) -> DataFrame:
    return _file_portal(wh, "portal_first")


@model("staging_third_portal", "table")
def staging_third_portal(wh: Warehouse) -> DataFrame:
    return _file_portal(wh, "portal_third")


@model("dim_site", "table")
def dim_site(wh: Warehouse) -> DataFrame:
    """One row per site of all portals, with what its data sources add up to. Sites of the first portal find their company by name."""
    sources = wh.ref("staging_datasources")
    rolled = sources.groupBy("site_id").agg(F.sum("n_devices").alias("n_devices"), F.bool_or("has_smart_meter").alias("has_smart_meter"))
    for column in ("handlers", "device_types"):
        rolled = rolled.join(listagg_distinct(sources.where(c(column).isNotNull()), ["site_id"], column, ";", column), "site_id", "left")
    second = wh.ref("staging_sites").select("site_id", "site_name", c("portal_company_id").cast("string").alias("company_id"), c("country_id").alias("country"), "capacity",
                                            "create_date", "is_live", "status").join(rolled, "site_id", "left")
    first = wh.ref("staging_first_portal").withColumn("company_id", F.concat(F.lit("name:"), norm_name(c("company_name")))).drop("company_name")
    third = wh.ref("staging_third_portal").withColumn("company_id", F.lit(None).cast("string")).drop("company_name")
    keys = wh.ref("company_members").join(wh.ref("dim_company").select("entity_system", "entity_id", "company_sk"), ["entity_system", "entity_id"])
    companies = keys.where("system <> 'crm'").select(F.when(c("system") == "first", F.concat(F.lit("name:"), c("record_id"))).otherwise(c("record_id")).alias("company_id"), "company_sk")
    countries = wh.ref("dim_country").select(c("country_id").alias("country"), "country_sk")
    return portal.site_dim({"first": first, "second": second, "third": third}, companies, countries)


@model("fact_site_ingestions", "table")
def fact_site_ingestions(wh: Warehouse) -> DataFrame:
    companies = wh.ref("portal_company_keys").select(c("portal_company_id").alias("company_id"), "company_sk")
    sites = wh.ref("dim_site").where("portal = 'second'").select("site_id", "site_sk")
    return portal.ingestions(wh.ref("staging_datasource_events"), companies, sites)


@model("company_source_states", "table")
def company_source_states(wh: Warehouse) -> DataFrame:
    """The data sources that sent something for a company on a day, as states that merge to months."""
    companies = wh.ref("portal_company_keys").select(c("portal_company_id").alias("company_id"), "company_sk")
    rows = joins.sk_lookup(wh.ref("staging_datasource_events").select("company_id", "source_id", "day"), companies, "company_id", "company_id", "company_sk")
    return distinct_states(dense_ids(rows, ["company_sk"], "source_id", "source_no"), ["company_sk", "day"], "source_no")


@model("mart_company_ingestions")
def mart_company_ingestions(wh: Warehouse) -> DataFrame:
    """Ingestions of a company by month. ``sources`` is the number of different sources of the month; ``rules.sources_as_sum`` gives the sum of
    the daily numbers of sites and handlers instead, as one source system's report does."""
    states = wh.ref("company_source_states").withColumn("month", month_first(c("day")))
    counts = count_states(merged_states(states, ["company_sk", "month"]), ["company_sk", "month"], "_sources")
    out = wh.ref("fact_site_ingestions").groupBy("company_sk", month_first(c("day")).alias("month")).agg(
        F.sum("sources").alias("sources"), F.sum(money(c("seconds"), 3)).alias("seconds"), F.sum(money(c("data_size"), 6)).alias("data_size"),
        F.sum("entries").alias("entries"))
    out = out.join(counts, ["company_sk", "month"], "left")
    return (out if wh.rules.sources_as_sum else out.withColumn("sources", F.coalesce("_sources", F.lit(0)))).drop("_sources")


@incremental("staging_api_tracking", "portal_tracking", "api_tracking", ts="event_date", day="day")
def staging_api_tracking(wh: Warehouse, rows: DataFrame) -> DataFrame:
    """Queries per user and day with the user's company. The log is read once: later runs read only later days."""
    users = wh.source("portal", "user").select(c("id").alias("user_id"), c("customer_id").alias("portal_company_id"))
    daily = rows.groupBy(day(c("event_date")).alias("day"), "user_id").agg(F.count(F.lit(1)).alias("count_queries"))
    return daily.join(users, "user_id", "left")


@model("fact_api_tracking")
def fact_api_tracking(wh: Warehouse) -> DataFrame:
    """Queries per user and day with the company key."""
    return joins.sk_lookup(wh.ref("staging_api_tracking"), wh.ref("portal_company_keys"), "portal_company_id", "portal_company_id", "company_sk")


@model("staging_cloud_costs", "table")
def staging_cloud_costs(wh: Warehouse) -> DataFrame:
    """Last load of every month plus the closed history, with the parts of the resource path."""
    rows = latest_batch(wh.source("files", "cloud_costs"), "entry_date", wh.source("files", "cloud_costs_history"))
    path = F.lower("resource_id")
    return rows.select(
        day(c("date")).alias("date_key"), F.coalesce(empty_to_null(F.initcap("subscription_name")), c("charge_type")).alias("subscription_name"),
        empty_to_null(path).alias("resource_id"), empty_to_null(split_part(path, "/", 8)).alias("resource_type"), empty_to_null(split_part(path, "/", 9)).alias("resource_name"),
        "service_family", money(c("cost")).alias("cost"), json_path(c("tags"), "Component").alias("component"),
        F.upper(F.coalesce(json_path(c("tags"), "Environment"), json_path(c("tags"), "ENVIRONMENT"))).alias("environment"))


@model("fact_cloud_costs")
def fact_cloud_costs(wh: Warehouse) -> DataFrame:
    storage = flag(c("component") == "Data storage")
    return wh.ref("staging_cloud_costs").groupBy(month_first(c("date_key")).alias("month")).agg(
        F.sum(F.when(storage, c("cost")).otherwise(0)).alias("storage"), F.sum(F.when(~storage, c("cost")).otherwise(0)).alias("processing"))


@model("staging_issues")
def staging_issues(wh: Warehouse) -> DataFrame:
    """Issue fields out of their JSON columns."""
    return wh.source("files", "issues").select(
        c("key").alias("issue_key"), json_path(c("assignee"), "displayName").alias("assignee"), json_path(c("status"), "name").alias("issue_status"),
        json_path(c("issuetype"), "name").alias("issue_type"), json_path(c("project"), "key").alias("team"), typed(c("story_points"), "double").alias("story_points"),
        (json_path(c("timetracking"), "timeSpentSeconds", "double") / 3600).alias("time_spent"), typed(c("company_id"), "bigint").alias("company_id"),
        typed(c("resolved"), "date").alias("resolution_date"), F.coalesce(F.size(F.from_json("subtasks", "array<string>")), F.lit(0)).alias("subtasks"))


@model("fact_sprint_issues")
def fact_sprint_issues(wh: Warehouse) -> DataFrame:
    """Finished issues; missing hours are the mean of issues of the same team and size."""
    done = wh.ref("staging_issues")
    filled = joins.impute_avg(done, ["team", "story_points"], "time_spent", "time_hours", digits=1)
    filled = filled.where(c("issue_status").isin("Done", "Closed") & ~c("issue_type").isin("Sub-task", "Epic"))
    out = joins.sk_lookup(filled.withColumn("time_hours", F.round("time_hours", 1)), wh.ref("dim_company").where("company_id IS NOT NULL"),
                          "company_id", "company_id", "company_sk")
    owners = wh.ref("dim_owner").select(c("employee_name").alias("assignee"), "owner_sk", "valid_from", "valid_to").where("assignee IS NOT NULL")
    return joins.asof_scd2(out, owners, "assignee", "resolution_date").drop("valid_from", "valid_to")


@model("mart_post_sites")
def mart_post_sites(wh: Warehouse) -> DataFrame:
    """Capacity overage report of the portal companies."""
    sites = wh.ref("dim_site").where("portal = 'second'").select(c("company_sk").alias("company_id"), "capacity", c("create_date").alias("created"), "is_live")
    deals = wh.ref("dim_deal").where("is_active AND stage_name = 'Won'").where((c("contract_start") <= wh.today) & (c("contract_end") >= wh.today))
    signed = deals.groupBy(c("company_sk").alias("company_id")).agg(
        F.coalesce(F.sum("single_sites"), F.lit(0)).alias("signed_sites"), F.coalesce(F.sum("volume_based_mwp"), F.lit(0.0)).alias("signed_mwp"))
    recent = wh.ref("fact_revenue_contracted").where(c("is_active") & c("is_change") & (c("valid_from") >= F.add_months(wh.today, -1)))
    changed = recent.join(wh.ref("dim_deal").select("deal_stage_sk", c("company_sk").alias("company_id")), "deal_stage_sk").select("company_id")
    names = wh.ref("dim_company").select(c("company_sk").alias("company_id"), "company_name")
    return portal.overage(sites, signed, changed, names, wh.today, hidden=f"%{wh.rules.own_domain.split('.')[0]}%")


@model("mart_post_companies")
def mart_post_companies(wh: Warehouse) -> DataFrame:
    """Site summary per company for the CRM, in the agreed column order."""
    cap = money(c("capacity"), 3)
    sites = wh.ref("dim_site").where("portal = 'second'").groupBy("company_sk").agg(
        F.count("site_sk").alias("total_sites"), F.round(F.sum(cap).cast("double") / 1000, 3).alias("total_capacity"),
        F.count_if(c("status") != "Registered").alias("active_sites"), F.count_if(c("capacity") < 200).alias("_small"))
    logins = wh.ref("dim_user").groupBy(c("portal_company_sk").alias("company_sk")).agg(F.max("last_login").alias("last_login"))
    deals = wh.ref("dim_deal").where("is_active AND stage_name = 'Won'").groupBy("company_sk").agg(F.sum("single_sites").alias("_signed"))
    out = sites.join(wh.ref("dim_company").select("company_sk", "company_id", "company_name"), "company_sk").join(logins, "company_sk", "left").join(deals, "company_sk", "left")
    return out.where("company_id IS NOT NULL AND company_id <> -1").select(
        "company_id", "company_name", "total_sites", "total_capacity", "active_sites",
        F.coalesce("last_login", F.lit("2000-01-01").cast("date")).alias("last_login"), (F.coalesce("_signed", F.lit(0)) - c("_small")).alias("sites_contracted_vs_created"))


@model("mart_post_contacts")
def mart_post_contacts(wh: Warehouse) -> DataFrame:
    return wh.ref("dim_user").where("crm_contact_id IS NOT NULL AND portal_user_id IS NOT NULL").select(
        "crm_contact_id", "portal_user_id", F.coalesce("last_login", F.lit("2000-01-01").cast("date")).alias("last_login"))
