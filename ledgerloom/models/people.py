"""Employees, absences, attendances and the owner dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import day, open_end
from ledgerloom.functions.logic import decode, flag
from ledgerloom.functions.text import remove, typed
from ledgerloom.models.warehouse import Warehouse, model
from ledgerloom.operators import history, joins, people
from ledgerloom.operators.ordered import collapse_islands, hot_keys, with_first_last, with_totals
from ledgerloom.operators.ranks import surrogate_rank

c = F.col


@model("staging_employees", "table")
def staging_employees(wh: Warehouse) -> DataFrame:
    """Employee versions, one per change of department, type or hours."""
    raw = wh.snapshot("employees")
    name = F.concat("first_name", F.lit(" "), "last_name")
    if wh.rules.renamed_people:
        name = decode(name, wh.rules.renamed_people, name)
    attr = "struct<attributes:struct<name:string>>"
    unit, team = F.from_json("department", attr)["attributes"]["name"], F.from_json("team", attr)["attributes"]["name"]
    sub = F.trim(F.when(unit == "Working students / Interns", team).otherwise(unit))
    main = decode(sub, wh.rules.departments, "Other") if wh.rules.departments else F.lit("Other")
    rows = raw.select(
        typed(c("id"), "bigint").alias("employee_id"), name.alias("employee_name"), F.initcap("gender").alias("gender"), sub.alias("sub_department"),
        main.alias("department"), flag(c("employment_type").isin("external", "Extern")).alias("is_external"), c("contract_kind").alias("employment_type"),
        typed(remove(c("weekly_hours"), ".00"), "int").alias("weekly_hours"), day(c("hire_date")).alias("hire_date"),
        day(c("termination_date")).alias("termination_date"), day(c("contract_end_date")).alias("contract_end_date"), c("termination_type"),
        c("valid_from").cast("timestamp_ntz").alias("valid_from"), F.coalesce(c("valid_to").cast("timestamp_ntz"), open_end()).alias("valid_to"))
    # an end date only counts while it is still the latest one known
    rows = with_first_last(rows, ["employee_id"], ["valid_from", "valid_to"], last={"_te": "termination_date", "_ce": "contract_end_date"})
    te, ce = F.when(c("termination_date") == c("_te"), c("termination_date")), F.when(c("contract_end_date") == c("_ce"), c("contract_end_date"))
    rows = with_totals(rows.withColumn("_end", F.least(te, ce)), ["employee_id"], F.min("_end").alias("employment_end"),
                       F.max("termination_type").alias("termination_reason"))
    rows = rows.withColumn("is_employed", F.coalesce(c("employment_end") > wh.today, F.lit(True)))
    hot = hot_keys("employee_id", rows)
    out = collapse_islands(rows, ["employee_id"], ["department", "sub_department", "employment_type", "weekly_hours"], "valid_from", "valid_to", hot,
                           also=["employee_name", "gender", "is_external", "hire_date", "employment_end", "termination_reason", "is_employed"])
    return out.withColumn("is_active", F.year("valid_to") == 9999)


@model("staging_personnel_expenses")
def staging_personnel_expenses(wh: Warehouse) -> DataFrame:
    """Monthly salary rows by employee name."""
    raw = wh.source("files", "expenses_personnel")
    name = F.trim("employee_name")
    if wh.rules.renamed_people:
        name = decode(name, wh.rules.renamed_people, name)
    return raw.select(name.alias("employee_name"), typed(c("date"), "date").alias("date_key"), typed(c("salary"), "decimal(10,2)").alias("gross_salary"),
                      typed(c("social"), "decimal(10,2)").alias("social_security"))


@model("staging_absences")
def staging_absences(wh: Warehouse) -> DataFrame:
    kind = F.from_json("time_off_type", "struct<attributes:struct<category:string>>")["attributes"]["category"]
    rows = wh.source("hr", "absences").where("status = 'approved'").select(
        typed(c("employee"), "bigint").alias("employee_id"), kind.alias("kind"), day(c("start_date")).alias("start_date"), day(c("end_date")).alias("end_date"),
        c("half_day_start").cast("boolean").alias("half_start"), c("half_day_end").cast("boolean").alias("half_end"))
    return people.absence_days(rows)


@model("staging_attendances")
def staging_attendances(wh: Warehouse) -> DataFrame:
    rows = wh.source("hr", "attendances").where("status = 'confirmed'").select(
        typed(c("employee"), "bigint").alias("employee_id"), day(c("date")).alias("day"), "start_time", "end_time",
        typed(c("break"), "int").alias("break_minutes"))
    return people.worked_hours(rows)


@model("dim_owner", "table")
def dim_owner(wh: Warehouse) -> DataFrame:
    """Employees and CRM owners by department and salary over time, matched by name; people without an HR
    history get one open version."""
    staff = wh.ref("staging_employees").withColumn("valid_from", c("valid_from"))
    pay = wh.ref("staging_personnel_expenses").where("gross_salary <> 0 OR social_security <> 0").select(
        "employee_name", c("date_key").cast("timestamp_ntz").alias("valid_from"), "gross_salary", "social_security")
    state = ["employee_id", "department", "sub_department", "employment_type", "weekly_hours", "gender", "is_external", "is_employed", "hire_date", "employment_end"]
    hot = hot_keys("employee_name", staff, pay)
    line = history.merge_histories(staff, pay, "employee_name", state, ["gross_salary", "social_security"], hot)
    owners = wh.ref("staging_owners")
    internal = c("email").like("%" + wh.rules.own_domain)
    named = owners.where(internal).join(line, "employee_name", "full").unionByName(owners.where(~internal | c("email").isNull()), allowMissingColumns=True)
    out = named.withColumns({
        "is_staff": flag(c("email").like("%" + wh.rules.own_domain) | ~c("is_external")), "department": F.coalesce("department", "team"),
        "valid_from": day(F.coalesce("valid_from", F.lit("2015-01-01").cast("timestamp_ntz"))), "valid_to": day(F.coalesce("valid_to", open_end()))})
    out = out.withColumn("is_active", F.year("valid_to") == 9999)
    return surrogate_rank(out, ["employee_name", "owner_id", "valid_from"], "owner_sk")


@model("fact_attendances")
def fact_attendances(wh: Warehouse) -> DataFrame:
    """Hours, absence and remote work per employee day with the owner version of that day."""
    out = people.attendance(wh.ref("staging_attendances"), wh.ref("staging_absences"))
    owners = wh.ref("dim_owner").where("employee_id IS NOT NULL").select("employee_id", "owner_sk", "valid_from", "valid_to")
    return joins.asof_scd2(out, owners, "employee_id", "day").drop("valid_from", "valid_to")
