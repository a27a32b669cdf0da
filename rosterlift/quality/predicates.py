"""Row predicates of the rules: true for a value that breaks the rule, false for NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes of identifiers and times.
UUID_PATTERN = "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
ISO_SHAPES = ("____-__-__T__:__:__%", "____-__-__ __:__:__%")
YMD_SHAPE = "____-__-__"

# Address domains that are made up, for tests, or thrown away after use.
BLOCKED_DOMAINS = (
    "noemail.com", "fakeemail.com", "fake.com", "invalid.com", "dummy.com", "placeholder.com",
    "test.com", "testing.com", "example.com", "example.org", "example.net", "sample.com", "demo.com",
    "mailinator.com", "temp-mail.com", "tempmail.com", "guerrillamail.com", "10minutemail.com", "throwaway.email",
    "trashmail.com", "maildrop.cc", "yopmail.com", "sharklasers.com", "grr.la", "spam4.me", "tempr.email",
    "emailondeck.com", "getnada.com", "anonbox.net", "burnermail.io", "getairmail.com",
)

# Recognised currency codes.
CURRENCIES = tuple("""
    USD EUR JPY GBP AUD CAD CHF CNY SEK NZD MXN SGD HKD NOK TRY ZAR BRL INR KRW DKK
    PLN TWD RUB THB ILS AED CZK MYR HUF CLP PHP PKR BGN HRK ISK RON IDR VND EGP QAR
    SAR KWD BHD OMR JOD LBP KZT UZS AMD GEL AZN TJS KGS BYN UAH MDL ALL MKD RSD BAM
    KES UGX TZS NGN GHS XOF XAF MAD TND DZD LYD ETB MGA MUR SCR BWP NAD SZL LSL ZMW
    AOA CDF XDR COP PEN BOB PYG UYU VES GYD SRD FJD SBD TOP VUV WST PGK XPF NCX CFP
""".split())

# What a numeric text must not look like.
NOT_NUMERIC = (r"[^0-9+\-.eE]", r"^$", r"^[.eE]", r"[.eE]$", r"\..*\.", r"[eE].*[eE]")


def _text(value: Column) -> Column:
    return value.cast("string")


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def is_missing(value: Column) -> Column:
    return value.isNull()


def not_accepted(value: Column, accepted: Sequence[str]) -> Column:
    return _sure(~_text(value).isin(*[str(a) for a in accepted]))


def not_matching(value: Column, pattern: str) -> Column:
    return _sure(~_text(value).rlike(pattern))


def not_uuid(value: Column) -> Column:
    return not_matching(value, UUID_PATTERN)


def not_iso_timestamp(value: Column) -> Column:
    t, space = ISO_SHAPES
    return _sure(~_text(value).like(t) & ~_text(value).like(space))


def not_ymd_date(value: Column) -> Column:
    return _sure(~_text(value).like(YMD_SHAPE))


def has_html(value: Column) -> Column:
    return _sure(_text(value).rlike("<[a-zA-Z][^>]*>"))


def not_equal(value: Column, expected: str) -> Column:
    return _sure(_text(value) != F.lit(str(expected)))


def not_bool(value: Column, expected: bool) -> Column:
    return _sure(value.cast("boolean") != F.lit(expected))


def _at_signs(v: Column) -> Column:
    return F.length(v) - F.length(F.replace(v, F.lit("@"), F.lit("")))


def _after_at(v: Column) -> Column:
    return F.substring(v, F.instr(v, "@") + F.lit(1), F.length(v))


def not_basic_email(value: Column) -> Column:
    v = _text(value)
    return _sure((_at_signs(v) != 1) | ~_after_at(v).contains("."))


def email_problem(value: Column) -> Column:
    """The first thing wrong with an address, NULL for a good one or a missing one."""
    v = _text(value)
    local = F.when(v.contains("@"), F.substring_index(v, "@", 1)).otherwise("")
    domain = _after_at(v)
    last = F.substring_index(domain, ".", -1)
    rules = (  # fixed values: the reasons, in the order in which they are looked for
        (_at_signs(v) != 1, "wrong number of @ symbols"),
        (v.contains(" "), "contains spaces"),
        (v != F.trim(v), "leading/trailing whitespace"),
        (~domain.contains("."), "no dot in domain"),
        (v.startswith(".") | v.endswith("."), "starts or ends with dot"),
        (v.startswith("-") | v.endswith("-"), "starts or ends with hyphen"),
        (local.startswith(".") | local.endswith("."), "local part starts/ends with dot"),
        (local.contains(".."), "local part has consecutive dots"),
        (domain.contains(".."), "domain has consecutive dots"),
        (local.rlike(r"[^A-Za-z0-9._%+\-]"), "invalid character in local part"),
        (domain.rlike(r"[^A-Za-z0-9.\-]"), "invalid character in domain"),
        (domain.rlike(r"^-|\.-"), "domain segment starts with hyphen"),
        (domain.rlike(r"-\.|-$"), "domain segment ends with hyphen"),
        (v.rlike(r"[^\x00-\x7F]"), "contains non-ASCII characters"),
        (domain.startswith(".") | (F.length(last) < 2) | last.rlike("[^A-Za-z]"), "invalid TLD"),
    )
    out = F.when(rules[0][0], rules[0][1])
    for condition, reason in rules[1:]:
        out = out.when(condition, reason)
    return out


def not_strict_email(value: Column) -> Column:
    return email_problem(value).isNotNull()


def blocked_domain(value: Column) -> Column:
    """The throw-away domain of a well-formed address, else NULL."""
    v = _text(value)
    domain = F.lower(_after_at(v))
    return F.when((_at_signs(v) == 1) & domain.isin(*BLOCKED_DOMAINS), domain)


def has_blocked_domain(value: Column) -> Column:
    return blocked_domain(value).isNotNull()


def not_three_letters(value: Column) -> Column:
    return _sure(F.length(F.trim(_text(value))) != 3)


def unknown_currency(value: Column) -> Column:
    v = F.trim(_text(value))
    return _sure((F.length(v) == 3) & ~F.upper(v).isin(*CURRENCIES))


def not_numeric(value: Column) -> Column:
    return _sure(F.trim(_text(value)).rlike("|".join(NOT_NUMERIC)))


def not_bare_url(value: Column) -> Column:
    return _sure(F.trim(_text(value)).rlike(r"(?i)^https?://|^www\.|/$"))


def not_trimmed(value: Column) -> Column:
    return _sure(_text(value) != F.btrim(_text(value)))


def any_filled(columns: Sequence[str]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | _sure(F.trim(_text(F.col(c))) != "")
    return out


def holds_several(value: Column, kind: str = "text") -> Column:
    """A text with a list delimiter in it. A slash is one, except for kind ``url``, which is full of them."""
    return _sure(_text(value).rlike(r"[,;|\n\t]" if kind == "url" else r"[,;|/\n\t]"))
