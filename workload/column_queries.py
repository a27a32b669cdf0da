"""Column functions against the SQL of the macro or idiom they stand for."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterlift.functions import codes, contact, dates, ids, location, money, names, text
from rosterlift.functions.text import CRLF

from .base import CTX, Tables, query, src, uuid_sql

CONTACTS, POSTINGS, TEXTS = src("contacts"), src("postings"), src("id_texts")


def d_email(x: str) -> str:
    return (f"regexp_replace(regexp_replace(replace(lower(trim({x})), ' ', ''), '^[^a-zA-Z0-9@._-]+', ''), "
            f"'[^a-zA-Z0-9@._-]+$', '')")


def d_phone(x: str) -> str:
    """Digits; a leading plus or double zero says that the number is international."""
    abroad = f"regexp_matches({x}, '^\\s*([+]|00)')"
    digits = f"regexp_replace(regexp_replace({x}, '^\\s*00', ''), '[^0-9]', '', 'g')"
    return f"nullif(concat(CASE WHEN {abroad} THEN '+' END, {digits}) || substr({x}, 1, 0), '')"


def _bare(x: str) -> str:
    for prefix in ("https://www.", "http://www.", "https://", "http://", "www."):
        x = f"replace({x}, '{prefix}', '')"
    return f"trim({x}, '/')"


def d_linkedin(x: str) -> str:
    return _bare(f"replace(trim({x}), ' ', '')")


def d_website(x: str) -> str:
    return _bare(f"replace(lower(trim({x})), ' ', '')")


# Providers of private mail, those known by the beginning of their domain and those known by all of it.
MAIL_FAMILIES = ("gmail", "hotmail", "outlook", "yahoo", "aol", "icloud", "protonmail", "gmx", "yandex")
MAIL_DOMAINS = ("me.com", "live.com", "msn.com", "comcast.net", "mail.com", "zoho.com", "qq.com", "naver.com", "web.com", "t-mobile.com")


def d_personal(x: str) -> str:
    whole = "|".join(d.replace(".", "[.]") for d in MAIL_DOMAINS)
    return f"regexp_matches(lower(coalesce({x}, '')), '@(({'|'.join(MAIL_FAMILIES)})[^@]*|{whole})$')"


def d_tags(x: str, put: str = "") -> str:
    return f"regexp_replace({x}, '<[^>]+>', '{put}', 'g')"


def d_clean_html(x: str) -> str:
    """Scripts, styles, tags and entities give a space, line breaks a line; white space is then folded."""
    for kind in ("script", "style"):
        x = f"regexp_replace({x}, '(?is)<{kind}.*?</{kind}>', ' ', 'g')"
    x = f"regexp_replace({x}, '(?i)<br\\s*/?>', chr(10), 'g')"
    return f"trim(regexp_replace(regexp_replace({x}, '<[^>]+>|&[A-Za-z0-9#]+;', ' ', 'g'), '\\s+', ' ', 'g'))"


# What a tag becomes in Markdown, in this order; ~ stands for a line break.
MARKDOWN = (("<h1[^>]*>([^<]*)</h1>", "~# \\1~"), ("<h2[^>]*>([^<]*)</h2>", "~## \\1~"), ("<br[^>]*>|</p>|<p[^>]*>", "~~"),
            ("<(strong|b)>([^<]*)</[^>]*>", "**\\2**"), ("<(em|i)>([^<]*)</[^>]*>", "_\\2_"), ("<li[^>]*>([^<]*)</li>", "~- \\1"),
            ("<[^>]+>|&[a-z]+;|&#[0-9]+;", " "))


def d_markdown(x: str) -> str:
    for tag, text in MARKDOWN:
        x = f"regexp_replace({x}, '{tag}', replace('{text}', '~', chr(10)), 'g')"
    return x


def d_scrub(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '[^a-zA-Z0-9 ]+', ' ', 'g'))"


def d_locality(*parts: str) -> str:
    shown = f"concat_ws(', ', {', '.join(f'''nullif({p}, '')''' for p in parts)})"
    empty = f"coalesce({', '.join(f'''nullif({p}, '')''' for p in parts)}) IS NULL"
    return f"(CASE WHEN {empty} THEN NULL ELSE trim(regexp_replace({shown}, '[^a-zA-Z0-9, ]+', ' ', 'g')) END)"


def d_iso(x: str, style: str = "%Y-%m-%dT%H:%M:%S") -> str:
    return f"strftime({x}, '{style}')"


# The size bands, by their upper ends.
BANDS = ((10, "1-10"), (50, "11-50"), (200, "51-200"), (500, "201-500"), (1000, "501-1000"), (5000, "1001-5000"), (10000, "5001-10000"))


def d_range(x: str) -> str:
    ends = ", ".join(f"CASE WHEN {x} <= {end} THEN '{label}' END" for end, label in BANDS)
    return f"CASE WHEN {x} <> 0 THEN coalesce({ends}, '10000+') END"


def d_placeholder(x: str, digits_ok: bool = True) -> str:
    v = f"nullif(trim({x}), '')"
    more = "" if digits_ok else f" AND NOT regexp_matches({v}, '^[0-9]+$')"
    return (f"CASE WHEN {v} IS NOT NULL AND upper({v}) NOT IN ('0','00','000','0000','00000','-','.','NA','N/A','NULL','NONE') "
            f"AND {v} NOT LIKE '%linkedin.com%' AND {v} NOT LIKE '%http%' AND {v} NOT LIKE '%www.%'{more} THEN {v} END")


def d_stamp(x: str) -> str:
    def read(day: str) -> str:
        return f"coalesce(try_strptime({x}, '{day} %H:%M:%S'), try_strptime({x}, '{day}'))"
    return (f"CASE WHEN regexp_matches({x}, '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') THEN {read('%d/%m/%Y')} "
            f"WHEN regexp_matches({x}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN {read('%Y-%m-%d')} END")


def d_number(x: str, n: int) -> str:
    found = f"regexp_extract_all({x}, '(\\d[\\d,]*\\.?\\d*)', 1)[{n}]"
    return f"CAST(round(TRY_CAST(replace({found}, ',', '') AS DECIMAL(15,2))) AS BIGINT)"


@query("f01_uuid", f"SELECT id, {uuid_sql('id', 'email')} AS uid, {uuid_sql('id')} AS uid_plain FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", ids.uuid_from("acme", "id", "email").alias("uid"),
                             ids.uuid_from("acme", "id").alias("uid_plain"))


@query("f02_email_norm", f"SELECT id, {d_email('email')} AS email FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", contact.email_norm("email").alias("email"))


@query("f03_phone_norm", f"SELECT id, {d_phone('phone')} AS phone, {d_phone('mobile')} AS mobile FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", contact.phone_norm("phone").alias("phone"), contact.phone_norm("mobile").alias("mobile"))


@query("f04_linkedin_norm", f"SELECT id, {d_linkedin('linkedin')} AS linkedin FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", contact.linkedin_norm("linkedin").alias("linkedin"))


@query("f05_website_norm", f"SELECT id, {d_website('website')} AS website FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", contact.website_norm("website").alias("website"))


@query("f05_website_norm_pages", f"SELECT page_id, {d_website('url')} AS url FROM pages")
def _(t: Tables):
    return t.pages.select("page_id", contact.website_norm("url").alias("url"))


@query("f06_personal_email",
       f"SELECT id, {d_personal('email')} AS is_personal, {d_personal(d_email('email'))} AS is_personal_clean FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", contact.is_personal_email("email").alias("is_personal"),
                             contact.is_personal_email(contact.email_norm("email")).alias("is_personal_clean"))


@query("f07_clean_html", f"SELECT page_id, {d_clean_html('html')} AS body FROM pages")
def _(t: Tables):
    return t.pages.select("page_id", text.clean_html("html").alias("body"))


@query("f08_html_to_markdown", f"SELECT page_id, {d_markdown('html')} AS body FROM pages")
def _(t: Tables):
    return t.pages.select("page_id", text.html_to_markdown("html").alias("body"))


@query("f09_strip_tags", f"SELECT page_id, {d_tags('html')} AS joined, {d_tags('html', ' ')} AS spaced FROM pages")
def _(t: Tables):
    return t.pages.select("page_id", text.strip_tags("html").alias("joined"), text.strip_tags("html", " ").alias("spaced"))


@query("f10_location_locality",
       f"SELECT id, {d_locality('address1', 'address2', 'city', 'state', 'zip', 'country')} AS place FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", location.location_locality("address1", "address2", "city", "state", "zip", "country")
                             .alias("place"))


@query("f11_number_range", f"SELECT id, {d_range('headcount')} AS size FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", codes.headcount_range("headcount").alias("size"))


@query("f12_country",
       f"SELECT id, CASE country_id WHEN 1 THEN 'United States' WHEN 2245 THEN 'France' WHEN 2359 THEN 'United Kingdom' END "
       f"AS country FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", codes.country_name("country_id").alias("country"))


@query("f13_join_words",
       f"SELECT id, trim(coalesce(address1, '') || ' ' || coalesce(city, '') || ' ' || coalesce(state, '')) AS words FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", text.join_words("address1", "city", "state").alias("words"))


@query("f14_string_to_timestamp", f"SELECT id, {d_iso(d_stamp('mixed'))} AS at FROM {TEXTS}")
def _(t: Tables):
    return t.id_texts.select("id", dates.string_to_timestamp("mixed").alias("at"))


@query("f16_iso_styles",
       f"SELECT event_id, {d_iso('ts')} AS seconds, {d_iso('ts', '%Y-%m-%dT%H:%M:%SZ')} AS zulu, "
       f"{d_iso('ts', '%Y-%m-%dT00:00:00')} AS midnight, {d_iso('ts', '%Y-%m-%dT00:00:00Z')} AS midnight_zulu, "
       f"{d_iso('ts', '%Y-%m-%dT%H:%M:%S.%g')} AS millis, {d_iso('ts', '%Y-%m-%d')} AS day FROM events")
def _(t: Tables):
    return t.events.select("event_id", *[dates.iso("ts", s).alias(s) for s in ("seconds", "zulu", "midnight", "midnight_zulu",
                                                                            "millis")], dates.iso("ts", "date").alias("day"))


@query("f17_epoch_midnight", f"SELECT id, strftime(to_timestamp(epoch) AT TIME ZONE 'UTC', '%Y-%m-%dT00:00:00') AS at FROM {TEXTS}")
def _(t: Tables):
    return t.id_texts.select("id", dates.epoch_midnight("epoch").alias("at"))


@query("f18_year_month", f"""
SELECT id,
  CASE WHEN year > 0 AND month BETWEEN 1 AND 12 THEN lpad(CAST(year AS VARCHAR), 4, '0') || '-' || lpad(CAST(month AS VARCHAR), 2, '0') || '-01'
       WHEN year > 0 THEN lpad(CAST(year AS VARCHAR), 4, '0') || '-01-01' ELSE '{CTX.today}' END AS started_at,
  CASE WHEN coalesce(lower(current), 'false') = 'true' THEN NULL
       WHEN year > 0 AND month BETWEEN 1 AND 12 THEN lpad(CAST(year AS VARCHAR), 4, '0') || '-' || lpad(CAST(month AS VARCHAR), 2, '0') || '-30'
       WHEN year > 0 THEN lpad(CAST(year AS VARCHAR), 4, '0') || '-12-30' END AS finished_at
FROM {TEXTS}""")
def _(t: Tables):
    return t.id_texts.select("id", dates.year_month_start("year", "month", F.lit(CTX.today)).alias("started_at"),
                             dates.year_month_end("year", "month", "current").alias("finished_at"))


@query("f19_sentinel_date", f"SELECT id, nullif(left(open_end, 10), '9999-12-31') AS ended FROM {TEXTS}")
def _(t: Tables):
    return t.id_texts.select("id", dates.drop_sentinel("open_end").alias("ended"))


_BARE_NAME = "regexp_replace(regexp_replace(name, '\\(.*\\)', ''), '\\(.*$', '')"


@query("f20_name_split",
       f"SELECT id, split_part({_BARE_NAME}, ' ', 1) AS first_name, "
       f"substring({_BARE_NAME}, length(split_part({_BARE_NAME}, ' ', 1)) + 2) AS last_name FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", names.first_name("name").alias("first_name"), names.last_name("name").alias("last_name"))


@query("f20_name_split_hash",
       "SELECT s_suppkey AS id, split_part(s_name, '#', 1) AS first_name, substring(s_name, length(split_part(s_name, '#', 1)) + 2) "
       "AS last_name FROM supplier")
def _(t: Tables):
    return t.supplier.select(F.col("s_suppkey").alias("id"), names.first_name("s_name", "#").alias("first_name"),
                             names.last_name("s_name", "#").alias("last_name"))


@query("f21_host_strip",
       f"SELECT id, regexp_replace(website, '^(https?://)?(www\\.)?', '') AS bare, "
       f"regexp_replace(regexp_replace(lower(trim(website)), '^(https?://)?(www\\.)?', ''), '^twitter\\.com', 'x.com') AS x_url FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", contact.strip_host("website").alias("bare"),
                             contact.twitter_handle_url("website").alias("x_url"))


@query("f22_profile_url",
       f"SELECT id, nullif(regexp_replace(regexp_replace(regexp_extract('see ' || linkedin, '(https?://)?(www\\.)?linkedin\\.com/[^\\s?]+'), "
       f"'^https?://(www\\.)?', ''), '/$', ''), '') AS profile FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select(
        "id", contact.profile_url(F.concat(F.lit("see "), "linkedin")).alias("profile"))


@query("f23_number_extraction",
       f"SELECT id, {d_number('salary_text', 1)} AS low, {d_number('salary_text', 2)} AS second, "
       f"CASE WHEN regexp_matches(trim(salary_text), '^[0-9]+(\\.[0-9]+)?$') THEN CAST(round(TRY_CAST(salary_text AS DECIMAL(15,2))) AS BIGINT) END AS plain, "
       f"TRY_CAST(nullif(split_part(regexp_replace(trim(coalesce(salary_text, '')), '[^-0-9.]', '', 'g'), '.', 1), '') AS BIGINT) AS whole FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", money.nth_number("salary_text", 1).alias("low"), money.nth_number("salary_text", 2).alias("second"),
                             money.plain_amount("salary_text").alias("plain"), money.whole_part("salary_text").alias("whole"))


@query("f24_bonus", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(CASE WHEN base IS NOT NULL AND bonus BETWEEN 0 AND 100 THEN base * bonus / 100.0 ELSE bonus END) AS BIGINT) AS bonus,
  CASE WHEN base IS NOT NULL OR bonus IS NOT NULL THEN CAST(round(coalesce(base, 0) + coalesce(CASE WHEN base IS NOT NULL AND bonus BETWEEN 0 AND 100 THEN base * bonus / 100.0 ELSE bonus END, 0)) AS BIGINT) END AS total
FROM (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE CAST(l_orderkey * 100 AS BIGINT) END AS base,
             CASE l_linenumber % 3 WHEN 0 THEN NULL WHEN 1 THEN l_partkey % 101 ELSE l_partkey * 10 + 101 END AS bonus FROM lineitem)""")
def _(t: Tables):
    rows = t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_orderkey * 100 END AS base",
        "CASE l_linenumber % 3 WHEN 0 THEN NULL WHEN 1 THEN l_partkey % 101 ELSE l_partkey * 10 + 101 END AS extra")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey",
                       F.round(money.bonus_amount("base", "extra")).cast("bigint").alias("bonus"),
                       money.total_pay("base", "extra").alias("total"))


@query("f25_salary_range", f"""
SELECT id, CASE WHEN coalesce(salary_from, 0) = 0 AND coalesce(salary_to, 0) = 0 THEN NULL
  WHEN salary_from = 0 THEN CAST(salary_to AS VARCHAR) WHEN salary_to = 0 THEN CAST(salary_from AS VARCHAR)
  ELSE CAST(salary_from AS VARCHAR) || ' - ' || CAST(salary_to AS VARCHAR) END AS salary FROM {POSTINGS}""")
def _(t: Tables):
    return t.postings.select("id", money.range_text("salary_from", "salary_to").alias("salary"))


@query("f26_fee_math", """
SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,6))) AS BIGINT) AS fee,
  CAST(CAST(CAST(l_tax AS DECIMAL(18,6)) * 100 AS DECIMAL(18,2)) AS VARCHAR) AS share FROM lineitem""")
def _(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", money.fee_amount("l_extendedprice", "l_discount").alias("fee"),
                             money.share_percent("l_tax").cast("string").alias("share"))


@query("f27_currency", f"""
SELECT id, CASE WHEN length(trim(country)) = 3 THEN upper(trim(country)) ELSE 'GBP' END AS a,
  CASE WHEN length(trim(left(segment, 3))) = 3 THEN upper(trim(left(segment, 3))) ELSE 'EUR' END AS b FROM {CONTACTS}""")
def _(t: Tables):
    return t.contacts.select("id", money.currency_code("country").alias("a"),
                             money.currency_code(F.left("segment", F.lit(3)), "EUR").alias("b"))


def _section(label: str, column: str) -> str:
    return f"CASE WHEN {column} IS NOT NULL AND trim({column}) != '' THEN '{label}' || trim({column}) END"


@query("f28_sections",
       f"SELECT id, concat_ws(chr(13) || chr(10), {_section('Name: ', 'name')}, {_section('City: ', 'city')}, {_section('Salary: ', 'salary_text')}) "
       f"AS note FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", text.sections([("Name: ", "name"), ("City: ", "city"), ("Salary: ", "salary_text")], CRLF).alias("note"))


@query("f29_email_note", f"""
SELECT id, 'From: ' || coalesce(email, '') || ' | To: ' || coalesce(email2, '') ||
  CASE WHEN name IS NOT NULL AND name <> '' THEN ' — ' || name ELSE '' END || ' ' || {d_clean_html("coalesce(html, '')")} AS note FROM {CONTACTS}""")
def _(t: Tables):
    return t.contacts.select("id", text.email_note("email", "email2", "name", "html").alias("note"))


@query("f30_scrub", f"SELECT id, {d_scrub('address1')} AS a, {d_scrub('city')} AS b FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", text.scrub("address1").alias("a"), text.scrub("city").alias("b"))


def _filled(*columns: str) -> str:
    return "coalesce(" + ", ".join(f"nullif(trim({c}), '')" for c in columns) + ")"


@query("f31_address_cascade", f"""
SELECT id, {_filled('address1', 'address2')} AS street,
  CASE WHEN s IS NOT NULL AND t IS NOT NULL AND p IS NOT NULL THEN s || ', ' || t || ', ' || p WHEN s IS NOT NULL AND t IS NOT NULL THEN s || ', ' || t
       WHEN t IS NOT NULL AND p IS NOT NULL THEN t || ', ' || p WHEN t IS NOT NULL THEN t WHEN p IS NOT NULL THEN p WHEN c IS NOT NULL THEN c ELSE n END AS place
FROM (SELECT *, {d_placeholder('address1')} AS s, {d_placeholder('city')} AS t, {d_placeholder('zip')} AS p, {d_placeholder('state')} AS c,
      {d_placeholder('country', False)} AS n FROM {CONTACTS})""")
def _(t: Tables):
    clean = location.clean_placeholder
    return t.contacts.select("id", location.prefer_filled("address1", "address2").alias("street"),
                             location.locality_cascade(clean("address1"), clean("city"), clean("zip"), clean("state"),
                                                       clean("country", digits_ok=False)).alias("place"))


@query("f32_comma_cleanup", f"""
SELECT id, regexp_replace(regexp_replace(line, '(^,*)|(,*$)', '', 'g'), ',+', ', ', 'g') AS line
FROM (SELECT id, coalesce(address1, '') || ',' || coalesce(address2, '') || ',' || coalesce(city, '') || ',' || coalesce(state, '') AS line FROM {CONTACTS})""")
def _(t: Tables):
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in ("address1", "address2", "city", "state")])
    return t.contacts.select("id", text.comma_cleanup(line).alias("line"))


@query("f33_trim_chars", f"SELECT id, trim(', ' || coalesce(address1, '') || ' ,', ',. ') AS a FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", text.trim_chars(F.concat(F.lit(", "), F.coalesce("address1", F.lit("")), F.lit(" ,")), ",. ").alias("a"))


@query("f34_latest_of", f"SELECT id, {d_iso('''date_trunc('second', greatest(hire, offer, interview2, interview1, sent))''')} AS at FROM {src('stages')}")
def _(t: Tables):
    return t.stages.select("id", dates.iso(dates.latest_of("hire", "offer", "interview2", "interview1", "sent")).alias("at"))


@query("f35_email_repair", f"""
SELECT id, CASE WHEN email LIKE '%@%' THEN regexp_replace(lower(trim(email)), '^([^@]+)-([^@]+\\.[^@]+)$', '\\1@\\2')
  ELSE regexp_replace(lower(trim(email)), '^([^-]+)-([^-]+.*)$', '\\1@\\2') END AS email
FROM (SELECT id, replace(email, '@c', '-c') AS email FROM {CONTACTS})""")
def _(t: Tables):
    return t.contacts.select("id", contact.repair_email(F.replace("email", F.lit("@c"), F.lit("-c"))).alias("email"))


@query("f36_dummy_email", f"""
SELECT id, CASE WHEN email LIKE '%@%' THEN lower(trim(email)) ELSE lower(regexp_replace(trim(company_name), '\\s+', '.', 'g')) || '@corp.example.com' END AS email
FROM {CONTACTS}""")
def _(t: Tables):
    return t.contacts.select("id", contact.dummy_email("email", "company_name", CTX.domain).alias("email"))


@query("f37_paths", """
SELECT page_id, replace('people/' || 'a\\b\\' || CAST(page_id AS VARCHAR) || '.pdf', '\\', '/') AS path,
  regexp_replace(split_part(url, '?', 1), '^.*/', '') AS base, regexp_replace(split_part(url, '?', 1), '^.*\\.([^.]+)$', '\\1') AS ext FROM pages""")
def _(t: Tables):
    place = F.split_part("url", F.lit("?"), F.lit(1))
    return t.pages.select("page_id", names.file_path(F.lit("a\\b\\"), "page_id", F.lit(".pdf")).alias("path"),
                          names.basename(place).alias("base"), names.file_extension(place).alias("ext"))


@query("f38_phone_kind", """
SELECT event_id, event_type, CASE WHEN replace(replace(event_type, 'click', 'mobile'), 'view', 'home') IN ('mobile', 'phone', 'home', 'cell', 'main', 'personal')
  THEN 'personal' ELSE 'corporate' END AS kind FROM events""")
def _(t: Tables):
    label = F.replace(F.replace("event_type", F.lit("click"), F.lit("mobile")), F.lit("view"), F.lit("home"))
    return t.events.select("event_id", "event_type", contact.phone_kind(label).alias("kind"))


@query("f39_strip_prefix", "SELECT o_orderkey, CASE WHEN substring(s, 1, 1) = '*' THEN substring(s, 2) ELSE s END AS label "
       "FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '*' || o_orderpriority ELSE o_orderpriority END AS s FROM orders)")
def _(t: Tables):
    label = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("*"), "o_orderpriority")).otherwise(F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", text.strip_prefix(label, "*").alias("label"))


@query("f41_degree_split", f"""
SELECT id, CASE WHEN v IS NULL THEN NULL ELSE trim(regexp_replace(v, ',[^,]*$', '')) END AS degree,
  CASE WHEN v LIKE '%,%' THEN trim(split_part(v, ',', length(v) - length(replace(v, ',', '')) + 1)) END AS study
FROM (SELECT id, nullif(trim(list_text), '') AS v FROM {CONTACTS})""")
def _(t: Tables):
    return t.contacts.select("id", names.degree_part("list_text").alias("degree"), names.field_of_study_part("list_text").alias("study"))


@query("f42_title_company", f"""
SELECT id, nullif(trim(split_part(email, '@', 1)), '') AS title, coalesce(nullif(trim(city), ''), nullif(trim(split_part(email, '@', 2)), '')) AS company
FROM {CONTACTS}""")
def _(t: Tables):
    title, company = names.title_and_company("email", "city")
    return t.contacts.select("id", title.alias("title"), company.alias("company"))


@query("f43_international_phone", f"SELECT id, regexp_replace({d_phone('phone')}, '^07', '+447') AS phone FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", contact.international_phone("phone").alias("phone"))


@query("f44_label_slug", f"SELECT id, lower(regexp_replace(trim(company_name || '  Group Name '), '\\s+', '_', 'g')) AS alias FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", text.label_slug(F.concat("company_name", F.lit("  Group Name "))).alias("alias"))


@query("f45_boilerplate", f"SELECT id, CASE WHEN html ILIKE '%this is a dummy job%' THEN NULL ELSE html END AS body FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", text.drop_boilerplate("html", "this is a dummy job").alias("body"))


@query("f22_f23_wild_text", """
SELECT doc_id, regexp_extract(text, '[A-Za-z0-9._-]+@[A-Za-z0-9-]+\\.[A-Za-z.]+') AS address, length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits
FROM documents""")
def _(t: Tables):
    return t.documents.select("doc_id", F.regexp_extract("text", r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+\.[A-Za-z.]+", 0).alias("address"),
                              F.length(F.regexp_replace("text", "[^0-9]", "")).alias("n_digits"))
