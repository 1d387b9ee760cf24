"""Queries over the driver's tables, one per operator, with the SQL that gives the same rows."""

from checks import align, cameras, episodes, inspect  # noqa: F401
from checks.tables import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
