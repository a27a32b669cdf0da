"""Salaries, fees and currencies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnLike, as_col, blank_to_null, drop_matches, text

_NUMBER = r"(\d[\d,]*\.?\d*)"


def nth_number(value: ColumnLike, n: int) -> Column:
    """The n-th number in a free text as a whole amount; NULL when there are fewer."""
    found = F.get(F.regexp_extract_all(text(value), F.lit(_NUMBER), F.lit(1)), F.lit(n - 1))
    return F.round(drop_matches(found, ",").try_cast("decimal(15,2)")).cast("bigint")


def plain_amount(value: ColumnLike) -> Column:
    """A text that is a plain number, as a whole amount; NULL otherwise."""
    v = F.btrim(text(value))
    return F.when(v.rlike(r"^[0-9]+(\.[0-9]+)?$"), F.round(v.try_cast("decimal(15,2)")).cast("bigint"))


def whole_part(value: ColumnLike) -> Column:
    """Digits before the decimal point once currency signs and separators are dropped."""
    kept = drop_matches(F.trim(F.coalesce(text(value), F.lit(""))), "[^-0-9.]")
    return F.split_part(kept, F.lit("."), F.lit(1)).try_cast("bigint")


def salary_range(text_value: ColumnLike) -> tuple[Column, Column]:
    """(low, high): first and second number of an expectation; one number serves as both."""
    low = nth_number(text_value, 1)
    return low, F.coalesce(nth_number(text_value, 2), low)


def bonus_amount(base: ColumnLike, bonus: ColumnLike) -> Column:
    """A bonus of 0 to 100 on a known base is a percentage; anything else is an amount."""
    b, extra = as_col(base), as_col(bonus)
    return F.when(b.isNotNull() & extra.between(0, 100), b * extra / F.lit(100.0)).otherwise(extra.cast("double"))


def total_pay(base: ColumnLike, bonus: ColumnLike) -> Column:
    b, extra = as_col(base), as_col(bonus)
    total = F.coalesce(b.cast("double"), F.lit(0.0)) + F.coalesce(bonus_amount(b, extra), F.lit(0.0))
    return F.when(b.isNotNull() | extra.isNotNull(), F.round(total).cast("bigint"))


def range_text(low: ColumnLike, high: ColumnLike) -> Column:
    """``low - high``; a zero or missing end is left out, and two of them give NULL."""
    ends = [F.when(as_col(v) != 0, F.trim(text(v))) for v in (low, high)]
    return F.nullif(F.concat_ws(" - ", *ends), F.lit(""))


def fee_amount(salary: ColumnLike, rate: ColumnLike) -> Column:
    product = as_col(salary).cast("decimal(18,2)") * as_col(rate).cast("decimal(18,6)")
    return F.round(product).cast("bigint")


def share_percent(rate: ColumnLike) -> Column:
    return (as_col(rate).cast("decimal(18,6)") * 100).cast("decimal(18,2)")


def currency_code(value: ColumnLike, default: str = "GBP") -> Column:
    v = blank_to_null(value)
    return F.when(F.length(v) == 3, F.upper(v)).otherwise(default)
