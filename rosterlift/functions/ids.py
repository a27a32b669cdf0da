"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnLike, text


def uuid_from(client: str, *parts: ColumnLike) -> Column:
    """The 8-4-4-4-12 form of md5(client + parts); NULL when any part is NULL."""
    digest = F.md5(F.concat(F.lit(client), *[text(p) for p in parts]))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def compact(value: Column) -> Column:
    """The text as bytes, a uuid in lower case as its 16. Texts that differ give bytes that differ: the first tells the two apart."""
    uuid = value.rlike("\\A[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\\z")
    packed = F.concat(F.lit(b"u"), F.unhex(F.replace(value, F.lit("-"), F.lit(""))))
    return F.when(uuid, packed).otherwise(F.concat(F.lit(b"t"), value.cast("binary")))


def expanded(value: Column) -> Column:
    """The text that ``compact`` was given."""
    uuid = F.regexp_replace(F.lower(F.hex(F.substring(value, 2, 16))), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(F.substring(value, 1, 1) == F.lit(b"u"), uuid).otherwise(F.substring(value, 2, 2147483647).cast("string"))
