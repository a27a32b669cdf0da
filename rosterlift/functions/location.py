"""Addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnLike, blank_to_null, drop_matches, text

# Texts that stand for "no address".
PLACEHOLDERS = ("0", "00", "000", "0000", "00000", "-", ".", "NA", "N/A", "NULL", "NONE")


def location_locality(*parts: ColumnLike) -> Column:
    """Non-blank parts joined by commas, other punctuation as spaces; NULL when all are blank."""
    joined = F.concat_ws(", ", *[F.nullif(text(p), F.lit("")) for p in parts])
    return F.when(joined != "", F.btrim(drop_matches(joined, "[^a-zA-Z0-9, ]+", " ")))


def street_address(line1: ColumnLike, line2: ColumnLike) -> Column:
    return F.nullif(F.concat_ws(", ", F.nullif(text(line1), F.lit("")), F.nullif(text(line2), F.lit(""))), F.lit(""))


def clean_placeholder(value: ColumnLike, digits_ok: bool = True) -> Column:
    """Trimmed text; NULL for placeholder words, web addresses and, on request, bare numbers."""
    v = blank_to_null(value)
    good = ~F.upper(v).isin(*PLACEHOLDERS) & ~v.rlike(r"linkedin\.com|http|www\.")
    if not digits_ok:
        good = good & ~v.rlike("^[0-9]+$")
    return F.when(good, v)


def locality_cascade(street: ColumnLike, town: ColumnLike, postcode: ColumnLike, county: ColumnLike,
                     country: ColumnLike) -> Column:
    """The best address line the filled parts allow, street needing a town beside it."""
    s, t, p, c, n = (text(x) for x in (street, town, postcode, county, country))
    with_street = F.when(t.isNotNull(), s)
    line = F.nullif(F.concat_ws(", ", with_street, t, p), F.lit(""))
    return F.coalesce(line, c, n)


def prefer_filled(*values: ColumnLike) -> Column:
    """First value that is not blank."""
    return F.coalesce(*[blank_to_null(v) for v in values])


def has_letters(value: ColumnLike) -> Column:
    """Trimmed text that holds at least two letters, else NULL."""
    v = F.trim(text(value))
    return F.when(v.rlike("[a-zA-Z].*[a-zA-Z]"), v)


def postal_digits(value: ColumnLike) -> Column:
    v = F.trim(text(value))
    return F.when(v.rlike("^[0-9]{3,}$"), v)
