"""Imports every plan module so that all queries are registered."""

from ledgerloom.plans import (aggregates, business, checks, finance, histories, joining,  # noqa: F401
                              loading, models, projections, scalars)
from ledgerloom.plans.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
