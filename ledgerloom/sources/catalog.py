"""Logical (group, table) names and the relations behind them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# The raw relations by source group; where the physical identifier differs it is given.
GROUPS: dict[str, dict[str, str]] = {
    "crm": {t: t for t in ("companies", "deals", "feedback_submissions", "line_items", "owners", "pipelines",
                           "products", "properties", "quotes", "tickets")},
    "crm_activity": {"engagements": "engagements", "contacts": "contacts"},
    "accounting": {"invoices": "Invoice", "invoice_items": "InvoicePos", "products": "Part", "customers": "Contact",
                   "receipts": "Voucher", "receipt_items": "VoucherPos", "payments": "CheckAccountTransaction",
                   "communication_way": "CommunicationWay"},
    "files": {"revenue_booked": "REVENUE_BOOKED", "expenses_personnel": "EXPENSES_PERSONNEL",
              "portal_third": "PORTAL_THIRD", "portal_first": "PORTAL_FIRST", "countries": "COUNTRY_CODES",
              "geographies": "COUNTRIES_GEOGRAPHY", "story_points": "STORY_POINTS", "sprint_review": "SPRINT_REVIEW",
              "ledgers_booked": "LEDGERS_BOOKED", "targets": "TARGETS", "cloud_costs": "CLOUD_COSTS",
              "cloud_costs_history": "CLOUD_COSTS_HISTORY", "issues": "ISSUES", "company_renaming": "COMPANY_RENAMING",
              "revenue_categories": "REVENUE_CATEGORIES"},
    "hr": {t: t for t in ("absences", "attendances", "employees", "projects")},
    "portal": {"company": "CUSTOMER", "device": "DEVICE", "datasource": "DATASOURCE",
               "datasource_meta": "DATASOURCEMETADATA", "site": "SITE", "address": "ADDRESS", "user": "USER"},
    "portal_metrics": {"site": "SITE"},
    "portal_tracking": {"api_tracking": "API_TRACKING_EVENTS"},
    "portal_events": {"data_source_event": "DATA_SOURCE_DAILY_STATISTICS"},
}


@dataclass
class Catalog:
    """Resolves logical names. ``locations`` maps a group to a folder or to a ``catalog.schema`` prefix;
    ``overrides`` places single relations elsewhere."""

    spark: SparkSession
    locations: dict[str, str]
    groups: dict[str, dict[str, str]] = field(default_factory=lambda: GROUPS)
    overrides: dict[tuple[str, str], str] = field(default_factory=dict)
    fmt: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)

    def resolve(self, group: str, table: str) -> str:
        if (group, table) in self.overrides:
            return self.overrides[(group, table)]
        if group not in self.groups or table not in self.groups[group]:
            raise KeyError(f"unknown source {group}.{table}")
        if group not in self.locations:
            raise KeyError(f"source group {group} has no location")
        place, name = self.locations[group], self.groups[group][table]
        return f"{place}/{name}.{self.fmt}" if "/" in place else f"{place}.`{name}`"

    def source(self, group: str, table: str) -> DataFrame:
        where = self.resolve(group, table)
        if "/" in where:
            return self.spark.read.format(self.fmt).options(**self.options).load(where)
        return self.spark.table(where)
