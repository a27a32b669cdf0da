from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def text(value: ColumnLike) -> Column:
    return as_col(value).cast("string")


def blank_to_null(value: ColumnLike) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(text(value)), F.lit(""))


def drop_matches(value: Column, pattern: str, put: str = "") -> Column:
    return F.regexp_replace(value, pattern, put)
