"""HTML, notes and other free text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnLike, as_col, blank_to_null, drop_matches, text

CRLF = "\r\n"


def strip_tags(value: ColumnLike, put: str = "") -> Column:
    return drop_matches(text(value), "<[^>]+>", put)


def clean_html(value: ColumnLike) -> Column:
    """One line of plain text: no script or style bodies, tags or entities, single spaces."""
    out = drop_matches(text(value), r"(?i)<script[\s\S]*?</script>|<style[\s\S]*?</style>", " ")
    out = strip_tags(out, " ")
    out = drop_matches(out, "&[A-Za-z0-9#]+;", " ")
    return F.trim(drop_matches(out, r"\s+", " "))


def html_to_markdown(value: ColumnLike) -> Column:
    out = text(value)
    for pattern, put in (  # fixed values: what a tag becomes, in this order
        (r"<h1[^>]*>([^<]*)</h1>", "\n# $1\n"),
        (r"<h2[^>]*>([^<]*)</h2>", "\n## $1\n"),
        (r"<br[^>]*>|</p>|<p[^>]*>", "\n\n"),
        (r"<(?:strong|b)>([^<]*)</[^>]*>", "**$1**"),
        (r"<(?:em|i)>([^<]*)</[^>]*>", "_$1_"),
        (r"<li[^>]*>([^<]*)</li>", "\n- $1"),
        (r"<[^>]+>|&[a-z]+;|&#[0-9]+;", " "),
    ):
        out = F.regexp_replace(out, pattern, put)
    return out


def scrub(value: ColumnLike) -> Column:
    """Letters, digits and spaces only; NULL becomes blank."""
    return F.btrim(drop_matches(F.coalesce(text(value), F.lit("")), "[^a-zA-Z0-9 ]+", " "))


def join_words(*values: ColumnLike) -> Column:
    """Values joined by single spaces, NULL as blank; never NULL."""
    return F.trim(F.concat_ws(" ", *[F.coalesce(text(v), F.lit("")) for v in values]))


def sections(parts: Sequence[tuple[str, ColumnLike]], between: str = CRLF) -> Column:
    """``Label: text`` lines, blank sections left out."""
    return F.concat_ws(between, *[F.when(blank_to_null(v).isNotNull(), F.concat(F.lit(label), F.trim(text(v))))
                                  for label, v in parts])


def email_note(sender: ColumnLike, receiver: ColumnLike, subject: ColumnLike, body: ColumnLike) -> Column:
    def plain(v: ColumnLike) -> Column:
        return F.coalesce(text(v), F.lit(""))

    topic = F.when(plain(subject) != "", F.concat(F.lit(" — "), text(subject))).otherwise("")
    return F.concat(F.lit("From: "), plain(sender), F.lit(" | To: "), plain(receiver), topic, F.lit(" "),
                    clean_html(plain(body)))


def comma_cleanup(value: ColumnLike) -> Column:
    """No commas at either end; runs of commas become one comma and a space."""
    return drop_matches(drop_matches(text(value), "^,+|,+$"), ",+", ", ")


def trim_chars(value: ColumnLike, chars: str) -> Column:
    return F.btrim(text(value), F.lit(chars))


def drop_boilerplate(value: ColumnLike, phrase: str) -> Column:
    """NULL for a text that carries the given stock phrase."""
    return F.when(text(value).ilike(f"%{phrase}%"), F.lit(None)).otherwise(text(value))


def strip_prefix(value: ColumnLike, prefix: str) -> Column:
    v = text(value)
    return F.when(v.startswith(prefix), F.substring(v, len(prefix) + 1, 1 << 30)).otherwise(v)


def shorten(value: ColumnLike, longest: int = 50) -> Column:
    """A report sample: long values cut, with an ellipsis."""
    v = text(value)
    return F.when(F.length(v) > longest, F.concat(F.left(v, F.lit(longest - 3)), F.lit("..."))).otherwise(v)


def label_slug(value: ColumnLike) -> Column:
    return F.lower(drop_matches(F.trim(as_col(value)), r"\s+", "_"))
