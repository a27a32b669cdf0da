"""Emails, phone numbers and profile or web addresses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnLike, as_col, drop_matches, text

# Address prefixes taken off a URL, in this order.
URL_PREFIXES = ("https://www.", "http://www.", "https://", "http://", "www.")

# Mail providers of private people. The first group matches any top-level domain.
PERSONAL_PROVIDERS = ("gmail", "hotmail", "outlook", "yahoo", "aol", "icloud", "protonmail", "gmx", "yandex")
PERSONAL_DOMAINS = ("me.com", "live.com", "msn.com", "comcast.net", "mail.com", "zoho.com", "qq.com", "naver.com",
                    "web.com", "t-mobile.com")

# Phone labels that mean a private number.
PERSONAL_PHONE_SOURCES = ("mobile", "phone", "home", "cell", "main", "personal")


def email_norm(value: ColumnLike) -> Column:
    lowered = F.replace(F.lower(F.trim(text(value))), F.lit(" "), F.lit(""))
    return drop_matches(lowered, r"^[^a-zA-Z0-9@._-]+|[^a-zA-Z0-9@._-]+$")


def phone_norm(value: ColumnLike) -> Column:
    raw = text(value)
    digits = drop_matches(raw, "[^0-9]")
    number = (F.when(raw.rlike(r"^\s*\+"), F.concat(F.lit("+"), digits))
              .when(raw.rlike(r"^\s*00"), F.concat(F.lit("+"), drop_matches(digits, "^00")))
              .otherwise(digits))
    return F.nullif(number, F.lit(""))


def _without_prefixes(value: Column) -> Column:
    bare = reduce(lambda c, prefix: F.replace(c, F.lit(prefix), F.lit("")), URL_PREFIXES, value)
    return F.btrim(bare, F.lit("/"))


def linkedin_norm(value: ColumnLike) -> Column:
    return _without_prefixes(F.replace(F.trim(text(value)), F.lit(" "), F.lit("")))


def website_norm(value: ColumnLike) -> Column:
    return _without_prefixes(F.replace(F.lower(F.trim(text(value))), F.lit(" "), F.lit("")))


def is_personal_email(value: ColumnLike) -> Column:
    """False, not NULL, for a missing address or one without a domain."""
    domains = "|".join(d.replace(".", r"\.") for d in PERSONAL_DOMAINS)
    pattern = f"@(?:(?:{'|'.join(PERSONAL_PROVIDERS)})[^@]*|(?:{domains}))$"
    return F.coalesce(F.lower(text(value)), F.lit("")).rlike(pattern)


def email_domain(value: ColumnLike) -> Column:
    return F.split_part(text(value), F.lit("@"), F.lit(2))


def in_domain(value: ColumnLike, domain: str) -> Column:
    return F.lower(text(value)).contains(domain)


def repair_email(value: ColumnLike) -> Column:
    """Put back the ``@`` of addresses stored with a hyphen in its place."""
    lowered = F.lower(F.trim(text(value)))
    with_at = F.regexp_replace(lowered, r"^([^@]+)-([^@]+\.[^@]+)$", "$1@$2")
    without_at = F.regexp_replace(lowered, r"^([^-]+)-([^-]+.*)$", "$1@$2")
    return F.when(text(value).like("%@%"), with_at).otherwise(without_at)


def dummy_email(email: ColumnLike, name: ColumnLike, domain: str) -> Column:
    """The address itself, or name@domain for a user without one."""
    made = F.concat(F.lower(F.regexp_replace(F.trim(text(name)), r"\s+", ".")), F.lit("@" + domain))
    return F.when(text(email).contains("@"), F.lower(F.trim(text(email)))).otherwise(made)


def strip_host(value: ColumnLike) -> Column:
    """A URL without scheme and ``www.`` at its start."""
    return drop_matches(text(value), r"^(https?://)?(www\.)?")


def twitter_handle_url(value: ColumnLike) -> Column:
    return F.regexp_replace(strip_host(F.lower(F.trim(text(value)))), r"^twitter\.com", "x.com")


def profile_url(value: ColumnLike) -> Column:
    """The first linkedin.com address inside a text, without scheme, query and trailing slash; NULL when none.

    ``www.`` goes with its scheme; an address written without one keeps it.
    """
    found = F.regexp_extract(text(value), r"(?:https?://)?(?:www\.)?linkedin\.com/[^\s?]+", 0)
    return F.nullif(drop_matches(drop_matches(found, r"^https?://(www\.)?"), "/$"), F.lit(""))


def github_norm(value: ColumnLike) -> Column:
    bare = reduce(lambda c, prefix: F.replace(c, F.lit(prefix), F.lit("")), ("https://", "http://", "www."),
                  F.lower(F.trim(text(value))))
    return F.btrim(bare, F.lit("/"))


def phone_kind(source: ColumnLike) -> Column:
    return F.when(as_col(source).isin(*PERSONAL_PHONE_SOURCES), "personal").otherwise("corporate")


def international_phone(value: ColumnLike, national: str = "07", country: str = "+447") -> Column:
    return drop_matches(phone_norm(value), f"^{national}", country)


def identity_shape(value: ColumnLike) -> Column:
    """email, linkedin, website or phone, read off the value itself; NULL for anything else."""
    v = F.lower(F.trim(text(value)))
    return (F.when(v.contains("linkedin.com"), "linkedin")
            .when(v.contains("@"), "email")
            .when(v.rlike(r"^(https?://|www\.)"), "website")
            .when(F.length(drop_matches(v, "[^0-9]")) > 3, "phone"))
