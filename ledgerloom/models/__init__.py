"""The business warehouse: raw relations -> staging -> dimensions and facts -> marts.

Every model is a function from a ``Warehouse`` to a DataFrame, registered under its name."""

from ledgerloom.models import accounting, crm, people, portal, reports  # noqa: F401
from ledgerloom.models.warehouse import MODELS, Rules, Warehouse

__all__ = ["MODELS", "Rules", "Warehouse"]
