"""Row filters that recur across vendors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnLike, as_col, text


def not_blank(value: ColumnLike) -> Column:
    return F.trim(text(value)) != ""


def is_live(flag: ColumnLike, style: str = "not_one") -> Column:
    """Not soft-deleted, in a vendor's own spelling. A NULL flag drops the row, except for ``no_date``."""
    c = as_col(flag)
    return {"not_one": lambda: c != 1, "zero": lambda: c == 0, "false": lambda: c == F.lit(False),
            "no_date": lambda: c.isNull()}[style]()


def is_real_name(value: ColumnLike, placeholder: str) -> Column:
    return F.lower(text(value)) != placeholder.lower()


def in_filter(value: ColumnLike, allowed: Sequence[str] | None) -> Column:
    """Value among the configured codes; no configuration keeps every row."""
    if allowed is None:
        return F.lit(True)
    return F.lower(F.trim(text(value))).isin(*[a.lower() for a in allowed])


def similar_to(value: ColumnLike, pattern: str) -> Column:
    """SQL SIMILAR TO: ``%`` and ``_`` are wildcards, the rest is a regex over the whole text."""
    return text(value).rlike("^(?:" + pattern.replace("%", ".*").replace("_", ".") + ")$")


def has_file_type(name: ColumnLike, types: Sequence[str] = ("pdf", "docx", "doc", "txt")) -> Column:
    return F.lower(text(name)).rlike(r"\.(" + "|".join(types) + ")$")


def is_person_row(name: ColumnLike, email: ColumnLike) -> Column:
    """Not a mailbox filed as a person: the name holds no ``@`` and differs from the address."""
    n = F.lower(F.trim(F.coalesce(text(name), F.lit(""))))
    e = F.lower(F.trim(F.coalesce(text(email), F.lit(""))))
    return ~n.contains("@") & ((n != e) | (n == ""))


def is_note_worth_keeping(subject: ColumnLike, body: ColumnLike, noise: Sequence[str], shortest_body: int = 30,
                          shortest_subject: int = 10) -> Column:
    """A subject off the noise list, and enough text in the body or the subject."""
    s, b = text(subject), text(body)
    return ~s.isin(*noise) & F.coalesce((F.length(b) > shortest_body) | (F.length(s) > shortest_subject), F.lit(False))


def is_noise(value: ColumnLike, patterns: Sequence[str]) -> Column:
    """Text matching any of the LIKE patterns, whatever its case; NULL is no noise."""
    v = F.coalesce(text(value), F.lit(""))
    out = F.lit(False)
    for pattern in patterns:
        out = out | v.ilike(pattern)
    return out
