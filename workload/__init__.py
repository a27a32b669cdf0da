"""Queries over the shared test tables, each with the SQL that says what it must return."""

from . import fixtures  # noqa: F401  (fills the fixture registry before the queries use it)
from . import column_queries, history_queries, quality_queries, relational_queries, table_queries  # noqa: F401
from .base import QUERIES

__all__ = ["QUERIES"]
