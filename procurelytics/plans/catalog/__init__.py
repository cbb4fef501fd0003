"""All registered queries: importing this package fills the registry."""

from procurelytics.plans.catalog import landing, monthly, prediction, reports, spend, texts  # noqa: F401
from procurelytics.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
