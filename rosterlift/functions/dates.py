"""Timestamps and dates; every canonical time is ISO-8601 text in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnLike, as_col, text

# The ISO styles of the canonical tables.
ISO_FORMATS = {
    "seconds": "yyyy-MM-dd'T'HH:mm:ss",
    "zulu": "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "midnight": "yyyy-MM-dd'T00:00:00'",
    "midnight_zulu": "yyyy-MM-dd'T00:00:00Z'",
    "millis": "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "date": "yyyy-MM-dd",
}


def iso(value: ColumnLike, style: str = "seconds") -> Column:
    return F.date_format(as_col(value), ISO_FORMATS[style])


def epoch_midnight(value: ColumnLike) -> Column:
    return iso(F.timestamp_seconds(as_col(value).try_cast("bigint")), "midnight")


def parse_timestamp(value: ColumnLike) -> Column:
    """Text as ``DD/MM/YYYY`` or ``YYYY-MM-DD``, with or without a time; NULL for anything else."""
    v = F.replace(F.trim(text(value)), F.lit("T"), F.lit(" "))

    def read(day: str) -> Column:
        return F.coalesce(F.try_to_timestamp(F.left(v, F.lit(19)), F.lit(f"{day} HH:mm:ss")),
                          F.try_to_timestamp(F.left(v, F.lit(10)), F.lit(day)))

    return (F.when(v.rlike("^[0-9]{2}/[0-9]{2}/[0-9]{4}"), read("dd/MM/yyyy"))
            .when(v.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), read("yyyy-MM-dd")))


def string_to_timestamp(value: ColumnLike, style: str = "seconds") -> Column:
    return iso(parse_timestamp(value), style)


def year_month_start(year: ColumnLike, month: ColumnLike, default: ColumnLike) -> Column:
    """First day of a month, of a year when the month is unusable, else ``default``."""
    y, m = as_col(year), as_col(month)
    padded = F.lpad(y.cast("string"), 4, "0")
    return (F.when((y > 0) & m.between(1, 12), F.concat(padded, F.lit("-"), F.lpad(m.cast("string"), 2, "0"), F.lit("-01")))
            .when(y > 0, F.concat(padded, F.lit("-01-01")))
            .otherwise(as_col(default)))


def year_month_end(year: ColumnLike, month: ColumnLike, current: ColumnLike) -> Column:
    """Day 30 of the month (December without one); NULL while the position is current."""
    y, m = as_col(year), as_col(month)
    padded = F.lpad(y.cast("string"), 4, "0")
    return (F.when(F.coalesce(F.lower(text(current)), F.lit("false")) == "true", F.lit(None))
            .when((y > 0) & m.between(1, 12), F.concat(padded, F.lit("-"), F.lpad(m.cast("string"), 2, "0"), F.lit("-30")))
            .when(y > 0, F.concat(padded, F.lit("-12-30"))))


def drop_sentinel(value: ColumnLike, sentinel: str = "9999-12-31") -> Column:
    """NULL for the far-future date that stands for 'still open'."""
    return F.nullif(F.left(text(value), F.lit(10)), F.lit(sentinel))


def latest_of(*values: ColumnLike) -> Column:
    """The latest of several times, to the second; missing ones are skipped."""
    return F.date_trunc("second", F.greatest(*[as_col(v) for v in values]))


def older_than_months(value: ColumnLike, today: str, months: int = 6) -> Column:
    return as_col(value).cast("date") < F.add_months(F.lit(today).cast("date"), -months)


def is_past(value: ColumnLike, now: Column) -> Column:
    return F.coalesce(as_col(value) < now, F.lit(False))
