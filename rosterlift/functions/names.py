"""Personal names, titles, degrees and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnLike, blank_to_null, drop_matches, text


def without_brackets(value: ColumnLike) -> Column:
    """A name without its bracketed remark; an unclosed bracket takes the rest with it."""
    return drop_matches(drop_matches(text(value), r"\(.*\)"), r"\(.*$")


def first_name(value: ColumnLike, separator: str = " ") -> Column:
    return F.split_part(without_brackets(value), F.lit(separator), F.lit(1))


def last_name(value: ColumnLike, separator: str = " ") -> Column:
    """Everything after the first separator."""
    name = without_brackets(value)
    return F.substring(name, F.length(first_name(value, separator)) + 2, F.length(name))


def degree_part(value: ColumnLike) -> Column:
    """What stands before the last comma, or the whole text."""
    return F.btrim(drop_matches(blank_to_null(value), ",[^,]*$"))


def field_of_study_part(value: ColumnLike) -> Column:
    """What stands after the last comma, else NULL."""
    v = blank_to_null(value)
    return F.when(v.contains(","), F.btrim(F.regexp_extract(v, "([^,]*)$", 1)))


def title_and_company(value: ColumnLike, company: ColumnLike) -> tuple[Column, Column]:
    """Split ``title @ company``; the company column wins when filled."""
    v = text(value)
    title = blank_to_null(F.split_part(v, F.lit("@"), F.lit(1)))
    return title, F.coalesce(blank_to_null(company), blank_to_null(F.split_part(v, F.lit("@"), F.lit(2))))


def file_path(folder: ColumnLike, name: ColumnLike, extension: ColumnLike, root: str = "people/") -> Column:
    return F.replace(F.concat(F.lit(root), text(folder), text(name), text(extension)), F.lit("\\"), F.lit("/"))


def basename(value: ColumnLike) -> Column:
    return drop_matches(text(value), "^.*/")


def file_extension(value: ColumnLike) -> Column:
    """What follows the last dot; a name without one is returned whole."""
    return F.regexp_replace(text(value), r"^.*\.([^.]+)$", "$1")


def file_kind(value: ColumnLike) -> Column:
    return F.when(F.lower(text(value)).rlike("resume|cv"), "resume").otherwise("other")
