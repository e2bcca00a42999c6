"""Queries over the driver's tables, one per operator, with their oracles."""

from waypost.catalog import jobs, records, relational, streams  # noqa: F401 - they register
from waypost.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
