"""Spark jobs that turn operational CRM exports into one canonical recruiting schema and prove the result sound."""

from .context import RunContext
from .session import configure, discard_durables, get_session

__all__ = ["RunContext", "configure", "discard_durables", "get_session"]
