"""Queries over the test tables that exercise every operator, with SQL twins."""

from tidemark.queries import calendars, log, routes, schemas, seek, targets, values  # noqa: F401
from tidemark.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
