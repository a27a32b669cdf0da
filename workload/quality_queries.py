"""Rules, integrity checks and table comparison against one SQL count per rule."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import functions as F

from rosterlift import diff
from rosterlift.plans import candidates, identities
from rosterlift.quality import WrittenChecks, evaluate, integrity, run_suite, violation_samples
from rosterlift.quality import predicates as P
from rosterlift.quality.checks import compile_checks
from rosterlift.quality.suite import missing_intervals, missing_positions, position_gaps, repeated_values
from rosterlift.session import scratch_folder
from rosterlift.sources import Outputs

from .base import CTX, QUERIES, Tables, query, src
from .column_queries import d_email
from .table_queries import STATUS, marks

CONTACTS, PEOPLE, COMPANIES, PROJECTS, USERS, APPS, POSTINGS, TEXTS = (src(n) for n in (
    "contacts", "people", "companies", "projects", "users", "applications", "postings", "id_texts"))


def report_sql(relation: str, table: str, *lines: tuple[str, str, str, str] | tuple[str, str, str, str, str]) -> str:
    """One SELECT per (column, rule, severity, count of bad rows[, passed])."""
    out = []
    for column, rule, severity, bad, *passed in lines:
        ok = passed[0] if passed else f"({bad}) = 0"
        out.append(f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, '{severity}' AS severity, "
                   f"CAST(({bad}) AS BIGINT) AS n_bad, {ok} AS passed FROM {relation}")
    return " UNION ALL ".join(out)


def count_if(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


def rule_query(name: str, fixture: str, rules: Mapping[str, Any], *lines, table: str = "sample") -> None:
    """Register a report of the given rules on a fixture, nothing else."""
    def run(t: Tables):
        return evaluate(getattr(t, fixture), table, rules, {})
    query(name, report_sql(f"{src(fixture)} q", table, *lines))(run)


rule_query("q01_required", "contacts", {"required": ["email", "absent"]}, ("email", "required", "fail", "0 * count(*)"), ("absent", "required", "fail", "1 + 0 * count(*)"))
rule_query("q02_nice_to_have", "contacts", {"nice_to_have": ["email", "absent"]}, ("email", "nice_to_have", "warn", "0 * count(*)"), ("absent", "nice_to_have", "warn", "1 + 0 * count(*)"))
rule_query("q03_not_null", "contacts", {"not_null": ["email", "city", "id", "absent"]}, ("email", "not_null", "fail", count_if("email IS NULL")), ("city", "not_null", "fail", count_if("city IS NULL")),
           ("id", "not_null", "fail", count_if("id IS NULL")))
rule_query("q04_unique", "contacts", {"unique": ["id", "linkedin", "has_company"]}, *[(c, "unique", "fail", f"count({c}) - count(DISTINCT {c})") for c in ("id", "linkedin", "has_company")])
rule_query("q05_unique_ci", "contacts", {"unique_ci": ["company_name", "website", "has_company"]}, *[(c, "unique_ci", "fail", f"count({c}) - count(DISTINCT lower(CAST({c} AS VARCHAR)))") for c in ("company_name", "website", "has_company")])
rule_query("q06_accepted_values", "contacts", {"allowed_values": {"segment": ["BUILDING", "MACHINERY"], "status": ["Active"], "has_company": ["x"]}},
           ("segment", "allowed_values", "fail", count_if("segment NOT IN ('BUILDING', 'MACHINERY')")), ("status", "allowed_values", "fail", count_if("status NOT IN ('Active')")))
rule_query("q07_uuid", "companies", {"uuid_columns": ["atlas_id", "name"]}, ("atlas_id", "uuid_columns", "fail", count_if("NOT regexp_matches(atlas_id, '^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$', 'i')")),
           ("name", "uuid_columns", "fail", count_if("name NOT LIKE '________-____-____-____-____________'")))
rule_query("q07_matches_regex", "contacts", {"matches_regex": {"zip": "^[0-9]{5}$"}}, ("zip", "matches_regex", "fail", count_if("NOT regexp_matches(zip, '^[0-9]{5}$')")))
_NOT_ISO = " AND ".join(f"{{0}} NOT LIKE '{s}'" for s in ("____-__-__T__:__:__", "____-__-__T__:__:__%", "____-__-__ __:__:__", "____-__-__ __:__:__%"))
rule_query("q08_iso8601", "id_texts", {"iso_timestamp": ["mixed", "open_end", "us"]}, *[(c, "iso_timestamp", "fail", count_if(f"{c} IS NOT NULL AND {_NOT_ISO.format(c)}")) for c in ("mixed", "open_end", "us")])
rule_query("q09_date_ymd", "id_texts", {"date_ymd_columns": ["mixed", "open_end"]}, *[(c, "date_ymd_columns", "fail", count_if(f"{c} NOT LIKE '____-__-__'")) for c in ("mixed", "open_end")])
rule_query("q10_warn_null", "contacts", {"warn_null": {"email": 0.1, "city": 0.5}}, ("email", "warn_null", "warn", count_if("email IS NULL"), f"{count_if('email IS NULL')} <= 0.1 * count(*)"),
           ("city", "warn_null", "warn", count_if("city IS NULL"), f"{count_if('city IS NULL')} <= 0.5 * count(*)"))
rule_query("q11_error_null", "contacts", {"error_null": {"email": 0.2, "zip": 0.1}}, ("email", "error_null", "fail", count_if("email IS NULL"), f"{count_if('email IS NULL')} <= 0.2 * count(*)"),
           ("zip", "error_null", "fail", count_if("zip IS NULL"), f"{count_if('zip IS NULL')} <= 0.1 * count(*)"))
rule_query("q12_constant_value", "contacts", {"constant": {"segment": "BUILDING", "has_company": True}}, ("segment", "constant", "fail", count_if("segment <> 'BUILDING'")),
           ("has_company", "constant", "fail", count_if("has_company <> TRUE")))
rule_query("q13_constant_any", "contacts", {"constant_any": ["segment", "email_status"]}, *[(c, "constant_any", "fail", f"CASE WHEN count(DISTINCT {c}) > 1 THEN 1 ELSE 0 END") for c in ("segment", "email_status")])
rule_query("q14_constant_across", "users", {"constant_across_table": ["status", "name"]}, *[(c, "constant_across_table", "fail", f"CASE WHEN min({c}) <> max({c}) THEN 1 ELSE 0 END") for c in ("status", "name")])
rule_query("q15_no_html", "contacts", {"no_html_columns": ["html", "city"]}, *[(c, "no_html_columns", "fail", count_if(f"regexp_matches({c}, '<[a-zA-Z][^>]*>')")) for c in ("html", "city")])

_AT = "length(e) - length(replace(e, '@', ''))"
_DOMAIN, _LOCAL = "substring(e, position('@' IN e) + 1)", "CASE WHEN position('@' IN e) > 0 THEN substring(e, 1, position('@' IN e) - 1) ELSE '' END"
_BASIC = f"({_AT}) != 1 OR position('.' IN {_DOMAIN}) = 0"


def _per(column: str, condition: str) -> str:
    """A condition on ``e`` written for a column."""
    import re
    return re.sub(r"\be\b", column, condition)


rule_query("q16_email_basic", "contacts", {"email": ["email", "email2"]}, *[(c, "email", "fail", count_if(f"{c} IS NOT NULL AND ({_per(c, _BASIC)})")) for c in ("email", "email2")])

_REASONS = f"""CASE WHEN ({_AT}) != 1 THEN 'wrong number of @ symbols' WHEN e LIKE '% %' THEN 'contains spaces' WHEN e != trim(e) THEN 'leading/trailing whitespace'
  WHEN position('.' IN {_DOMAIN}) = 0 THEN 'no dot in domain' WHEN e LIKE '.%' OR e LIKE '%.' THEN 'starts or ends with dot' WHEN e LIKE '-%' OR e LIKE '%-' THEN 'starts or ends with hyphen'
  WHEN {_LOCAL} LIKE '.%' OR {_LOCAL} LIKE '%.' THEN 'local part starts/ends with dot' WHEN {_LOCAL} LIKE '%..%' THEN 'local part has consecutive dots' WHEN {_DOMAIN} LIKE '%..%' THEN 'domain has consecutive dots'
  WHEN regexp_matches({_LOCAL}, '[^A-Za-z0-9._%+\\-]') THEN 'invalid character in local part' WHEN regexp_matches({_DOMAIN}, '[^A-Za-z0-9.\\-]') THEN 'invalid character in domain'
  WHEN regexp_matches({_DOMAIN}, '(^-|\\.-)') THEN 'domain segment starts with hyphen' WHEN regexp_matches({_DOMAIN}, '(-\\.|-$)') THEN 'domain segment ends with hyphen'
  WHEN regexp_matches(e, '[^\\x00-\\x7F]') THEN 'contains non-ASCII characters'
  WHEN {_DOMAIN} LIKE '.%' OR length(regexp_extract({_DOMAIN}, '[^.]*$')) < 2 OR regexp_matches(regexp_extract({_DOMAIN}, '[^.]*$'), '[^A-Za-z]') THEN 'invalid TLD' END"""
_ODD = """(CASE c_custkey % 14 WHEN 0 THEN NULL WHEN 1 THEN 'plain' WHEN 2 THEN 'a b@c.com' WHEN 3 THEN '.a@b.com' WHEN 4 THEN 'a@b.com-' WHEN 5 THEN 'a.@b.com' WHEN 6 THEN 'a..b@c.com' WHEN 7 THEN 'a@b..com'
  WHEN 8 THEN 'a!b@c.com' WHEN 9 THEN 'a@b_c.com' WHEN 10 THEN 'a@-b.com' WHEN 11 THEN 'a@b-.com' WHEN 12 THEN 'a@b.c1' ELSE 'ok' || CAST(c_custkey AS STRING) || '@TEST.com' END)"""


@query("q17_email_reason", f"SELECT id, {_REASONS} AS problem FROM (SELECT c_custkey AS id, {_ODD} AS e FROM customer)")
def _(t: Tables):
    return t.customer.select(F.col("c_custkey").alias("id"), P.email_problem(F.expr(_ODD)).alias("problem"))


rule_query("q17_email_strict", "contacts", {"valid_email": ["email"]}, ("email", "valid_email", "fail", count_if(f"email IS NOT NULL AND ({_per('email', _REASONS)}) IS NOT NULL")),
           ("email", "blocked_domain", "fail", count_if(f"({_per('email', _AT)}) = 1 AND lower({_per('email', _DOMAIN)}) IN ('mailinator.com', 'test.com')")))


@query("q18_blocked_domain", f"SELECT id, CASE WHEN ({_AT}) = 1 AND lower({_DOMAIN}) IN ('test.com', 'mailinator.com') THEN lower({_DOMAIN}) END AS domain FROM (SELECT c_custkey AS id, {_ODD} AS e FROM customer)")
def _(t: Tables):
    return t.customer.select(F.col("c_custkey").alias("id"), P.blocked_domain(F.expr(_ODD)).alias("domain"))


_MONEY = "(SELECT CASE o_orderkey % 6 WHEN 0 THEN 'GBP' WHEN 1 THEN ' usd ' WHEN 2 THEN 'EURO' WHEN 3 THEN 'ZZZ' WHEN 4 THEN '' END AS cur FROM orders)"


@query("q19_currency", report_sql(f"{_MONEY} q", "sample", ("cur", "currency", "fail", count_if("length(trim(cur)) != 3")),
                                  ("cur", "known_currency", "warn", count_if("length(trim(cur)) = 3 AND upper(trim(cur)) NOT IN ('GBP', 'USD', 'EUR')"))))
def _(t: Tables):
    rows = t.orders.selectExpr("CASE o_orderkey % 6 WHEN 0 THEN 'GBP' WHEN 1 THEN ' usd ' WHEN 2 THEN 'EURO' WHEN 3 THEN 'ZZZ' WHEN 4 THEN '' END AS cur")
    return evaluate(rows, "sample", {"currency": ["cur"]}, {})


_NUMERIC = " OR ".join((r"regexp_matches(v, '[^0-9+\-.eE]')", "v = ''", "regexp_matches(v, '^[.eE]')", "regexp_matches(v, '[.eE]$')", r"regexp_matches(v, '\..*\.')", "regexp_matches(v, '[eE].*[eE]')"))
_NUM = "CASE o_orderkey % 9 WHEN 0 THEN '12' WHEN 1 THEN ' 1.5 ' WHEN 2 THEN '1,5' WHEN 3 THEN '' WHEN 4 THEN '.5' WHEN 5 THEN '5.' WHEN 6 THEN '1.2.3' WHEN 7 THEN '1e5e6' END"


@query("q20_numeric", f"SELECT 'sample' AS table_name, 'num' AS column_name, 'numeric' AS rule, 'fail' AS severity, {count_if(_NUMERIC)} AS n_bad, {count_if(_NUMERIC)} = 0 AS passed FROM (SELECT trim({_NUM}) AS v FROM orders)")
def _(t: Tables):
    return evaluate(t.orders.selectExpr(f"{_NUM} AS num"), "sample", {"numeric": ["num"]}, {})


_URL = "trim({0}) ILIKE 'http://%' OR trim({0}) ILIKE 'https://%' OR trim({0}) ILIKE 'www.%' OR right(trim({0}), 1) = '/'"
rule_query("q21_url", "contacts", {"url": ["website", "linkedin"]}, *[(c, "url", "fail", count_if(_URL.format(c))) for c in ("website", "linkedin")])
rule_query("q22_trim", "contacts", {"trim": ["name", "email"]}, *[(c, "trim", "fail", count_if(f"{c} <> trim({c})")) for c in ("name", "email")])


@query("q23_location_coverage", f"""
SELECT 'sample' AS table_name, 'location' AS column_name, 'location_coverage' AS rule, 'fail' AS severity, {count_if('NOT ok')} AS n_bad, {count_if('ok')} >= 0.6 * count(*) AS passed
FROM (SELECT coalesce(trim(address1) <> '', FALSE) OR coalesce(trim(city) <> '', FALSE) AS ok FROM {CONTACTS})""")
def _(t: Tables):
    rows = t.contacts.selectExpr("address1 AS location_street_address", "city AS location_locality")
    return evaluate(rows, "sample", {"location_coverage": 0.6}, {})


rule_query("q24_is_boolean", "contacts", {"isBoolean": ["has_company", "email"]}, ("has_company", "is_boolean", "fail", "0 * count(*)"), ("has_company", "boolean_nulls", "warn", count_if("has_company IS NULL")),
           ("email", "is_boolean", "fail", "1 + 0 * count(*)"))
rule_query("q25_boolean_is", "contacts", {"boolean_is": {"has_company": True}}, ("has_company", "boolean_is", "fail", count_if("has_company IS DISTINCT FROM TRUE AND has_company IS NOT NULL")))
rule_query("q26_boolean_mixed", "contacts", {"booleanIsMixed": {"has_company": False}}, ("has_company", "boolean_is_mixed", "fail", "CASE WHEN bool_or(has_company) AND bool_or(NOT has_company) THEN 0 ELSE 1 END"))

_POS = "(SELECT p_type AS a, p_size AS p FROM part WHERE p_size % 7 <> 3 AND NOT (p_type = 'ECONOMY' AND p_size = 1))"


@query("q27_position_gaps", f"""
SELECT a AS attribute_id, min(p) AS starts_at, max(p) AS ends_at, CAST(max(p) - min(p) + 1 - count(DISTINCT p) AS BIGINT) AS n_missing FROM {_POS} GROUP BY a HAVING min(p) <> 1 OR max(p) - min(p) + 1 <> count(DISTINCT p)""")
def _(t: Tables):
    rows = t.part.where("p_size % 7 <> 3 AND NOT (p_type = 'ECONOMY' AND p_size = 1)")
    return position_gaps(rows, "p_type", "p_size")


@query("q27_missing_positions", f"""
WITH s AS (SELECT a, min(p) AS lo, max(p) AS hi, count(DISTINCT p) AS n FROM {_POS} GROUP BY a)
SELECT s.a AS attribute_id, CAST(x.p AS INT) AS position FROM s, range(0, 60) x(p) WHERE x.p > lo AND x.p < hi AND NOT EXISTS (SELECT 1 FROM {_POS} q WHERE q.a = s.a AND q.p = x.p)""")
def _(t: Tables):
    rows = t.part.where("p_size % 7 <> 3 AND NOT (p_type = 'ECONOMY' AND p_size = 1)")
    return missing_positions(rows, "p_type", "p_size")


@query("q27_missing_intervals", f"""
SELECT a AS attribute_id, p + 1 AS first_missing, nxt - 1 AS last_missing, nxt - p - 1 AS n_missing FROM (
  SELECT a, p, lead(p) OVER (PARTITION BY a ORDER BY p) AS nxt FROM (
    SELECT DISTINCT p_type AS a, CAST(p_size AS BIGINT) * CASE WHEN p_partkey % 50 = 0 THEN 40000000 ELSE 1 END AS p FROM part)) WHERE nxt > p + 1""")
def _(t: Tables):
    rows = t.part.selectExpr("p_type", "CAST(p_size AS BIGINT) * CASE WHEN p_partkey % 50 = 0 THEN 40000000 ELSE 1 END AS at")
    return missing_intervals(rows, "p_type", "at")


@query("q28_candidate_duplicates", f"""
SELECT 'candidates_x' AS table_name, 'atlas_project_id,atlas_person_id' AS column_name, 'candidate_duplicates' AS rule, 'fail' AS severity, count(*) AS n_bad, count(*) = 0 AS passed
FROM (SELECT project_id, person_id FROM {APPS} GROUP BY 1, 2 HAVING count(*) > 1)""")
def _(t: Tables):
    rows = t.applications.selectExpr("CAST(project_id AS STRING) AS atlas_project_id", "CAST(person_id AS STRING) AS atlas_person_id")
    return evaluate(rows, "candidates_x", {}, {}).where("rule = 'candidate_duplicates'")


@query("q28_worst_duplicates", f"SELECT project_id, person_id, count(*) AS count FROM {APPS} GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY 3 DESC, 1, 2 LIMIT 10")
def _(t: Tables):
    return repeated_values(t.applications, ["project_id", "person_id"])


@query("q29_global_rules", " UNION ALL ".join((
    report_sql(f"{PROJECTS} q", "project_company_contacts_x", ("created_at", "global_iso_timestamp", "fail", "0 * count(*)")),
    report_sql(f"{TEXTS} q", "other", ("atlas_id", "global_required", "fail", "1 + 0 * count(*)"), ("created_at", "global_iso_timestamp", "fail", count_if(f"mixed IS NOT NULL AND {_NOT_ISO.format('mixed')}"))))))
def _(t: Tables):
    from rosterlift.functions.dates import iso
    links = t.projects.select("id", iso("created_at").alias("created_at"))
    rows = t.id_texts.selectExpr("id", "mixed AS created_at")
    return evaluate(links, "project_company_contacts_x", {}).unionByName(evaluate(rows, "other", {}))


_CAND = QUERIES["e17_candidates"].sql


@query("q30_rule_report", f"""
WITH c AS ({_CAND}),
named AS (SELECT unnest(['atlas_id', 'person_id', 'atlas_person_id', 'project_id', 'atlas_project_id', 'status', 'atlas_owner_id']) AS n),
nice AS (SELECT unnest(['rejection_type', 'rejection_reason', 'rejected_at', 'atlas_rejected_by_id']) AS n)
SELECT 'candidates_x' AS table_name, 'atlas_id' AS column_name, 'global_required' AS rule, 'fail' AS severity, CAST(0 AS BIGINT) AS n_bad, TRUE AS passed
UNION ALL SELECT 'candidates_x', n, 'required', 'fail', 0, TRUE FROM named UNION ALL SELECT 'candidates_x', n, 'nice_to_have', 'warn', 0, TRUE FROM nice
UNION ALL {report_sql('c', 'candidates_x',
    ('created_at', 'global_iso_timestamp', 'fail', count_if('created_at IS NOT NULL AND ' + _NOT_ISO.format('created_at'))),
    ('updated_at', 'global_iso_timestamp', 'fail', count_if('updated_at IS NOT NULL AND ' + _NOT_ISO.format('updated_at'))),
    *[(x, 'not_null', 'fail', count_if(f'{x} IS NULL')) for x in 'atlas_id person_id atlas_person_id project_id atlas_project_id status owner_id atlas_owner_id'.split()],
    *[(x, 'uuid_columns', 'fail', count_if(f"NOT regexp_matches({x}, '^[0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}}$', 'i')")) for x in 'atlas_id atlas_person_id atlas_project_id atlas_owner_id atlas_rejected_by_id'.split()],
    ('rejected_at', 'iso_timestamp', 'fail', count_if('rejected_at IS NOT NULL AND ' + _NOT_ISO.format('rejected_at'))),
    ('status', 'allowed_values', 'fail', count_if("status NOT IN ('Added', 'Internal IV', 'Presented', 'Client IV', 'Offer', 'Hired')")),
    ('rejection_type', 'allowed_values', 'fail', count_if("rejection_type NOT IN ('by_client', 'by_us', 'self')")),
    ('rejection_reason', 'allowed_values', 'fail', count_if("rejection_reason NOT IN ('not_qualified', 'above_budget', 'accepted_another_offer', 'cultural_fit', 'location', 'other')")),
    ('id', 'unique', 'fail', 'count(id) - count(DISTINCT id)'), ('atlas_id', 'unique', 'fail', 'count(atlas_id) - count(DISTINCT atlas_id)'),
    ('atlas_project_id,atlas_person_id', 'candidate_duplicates', 'fail', 'count(*) - count(DISTINCT (atlas_project_id, atlas_person_id))'))}""")
def _(t: Tables):
    rows = candidates.build_candidates(t.applications, t.projects, t.people, t.users, CTX, marks(),
                                       t.applications.select("id", "status", "added_at"))
    checks = WrittenChecks()
    out = Outputs(scratch_folder(t.spark), watch=checks.watch)
    out.add("candidates_x", rows)
    return checks.report(out.tables).lines


_SMALL = {"users*": {"unique": ["email"], "not_null": ["id"]}, "companies*": {"unique": ["name"], "required": ["id", "missing"]}, "never*": {"required": ["id"]}}


@query("q30_suite_totals", f"""
SELECT 'users_a' AS table_name, 0 AS n_failed, 0 AS n_warned, 2 AS n_checks FROM {USERS} GROUP BY 1, 2, 3, 4
UNION ALL SELECT 'companies_a', 1 + CASE WHEN count(name) > count(DISTINCT name) THEN 1 ELSE 0 END, 0, 3 FROM {COMPANIES}""")
def _(t: Tables):
    return run_suite({"users_a": t.users, "companies_a": t.companies, "skipped": t.people}, _SMALL, {}, prefixes=("users", "companies")).per_table()


_SHORT = "CASE WHEN length(v) > 50 THEN left(v, 47) || '...' ELSE v END"


@query("q31_samples", f"""
SELECT 'sample' AS table_name, rule, c AS column_name, id AS row_id, {_SHORT} AS value, CAST(n AS INT) AS n FROM (SELECT *, row_number() OVER (PARTITION BY rule, c ORDER BY id) AS n FROM (
  SELECT CAST(id AS VARCHAR) AS id, 'no_html_columns' AS rule, 'html' AS c, html AS v FROM {CONTACTS} WHERE regexp_matches(html, '<[a-zA-Z][^>]*>')
  UNION ALL SELECT CAST(id AS VARCHAR), 'trim', 'name', name FROM {CONTACTS} WHERE name <> trim(name) UNION ALL SELECT CAST(id AS VARCHAR), 'url', 'website', website FROM {CONTACTS} WHERE {_URL.format('website')})) WHERE n <= 5""")
def _(t: Tables):
    checks = compile_checks("sample", t.contacts.schema, {"no_html_columns": ["html"], "trim": ["name"], "url": ["website"]})
    return violation_samples(t.contacts, "sample", checks, "id")


# -- integrity -------------------------------------------------------------------------------------------------

@query("k01_null_ids", f"""
SELECT unnest(['atlas_id', 'atlas_owner_id']) AS column_name, unnest([0, count(*) FILTER (u.atlas_id IS NULL)]) AS n_bad FROM {PROJECTS} p LEFT JOIN {USERS} u ON u.id = p.owner_id""")
def _(t: Tables):
    from rosterlift.operators.joins import fk_map
    return integrity.null_ids(fk_map(t.projects, "owner_id", t.users, "atlas_id", "atlas_owner_id"))


@query("k02_orphans", f"SELECT project_id AS missing_key, count(*) AS n_rows FROM {APPS} WHERE project_id NOT IN (SELECT id FROM {PROJECTS}) GROUP BY 1")
def _(t: Tables):
    return integrity.orphans(t.applications, "project_id", t.projects, "id")


@query("k03_count_variance", f"""
SELECT 'projects' AS table_name, (SELECT count(*) FROM orders) AS n_source, (SELECT count(*) FROM {PROJECTS}) AS n_target, abs((SELECT count(*) FROM {PROJECTS}) - (SELECT count(*) FROM orders)) <= 0.02 * (SELECT count(*) FROM orders) AS passed
UNION ALL SELECT 'companies', (SELECT count(*) FROM customer), (SELECT count(*) FROM {COMPANIES}), abs((SELECT count(*) FROM {COMPANIES}) - (SELECT count(*) FROM customer)) <= 0.1 * (SELECT count(*) FROM customer)""")
def _(t: Tables):
    return integrity.count_variance({"projects": (t.orders, t.projects, 0.02), "companies": (t.customer, t.companies, 0.1)})


_MIXED = f"(SELECT CASE WHEN id % 5 = 0 THEN 'phone' ELSE 'email' END AS type, CASE WHEN id % 7 = 0 THEN 'PhonePersonIdentity' ELSE 'EmailPersonIdentity' END AS class_type, {d_email('email')} AS value FROM {CONTACTS})"


@query("k04_type_mismatches", f"""
SELECT type, {count_if("class_type IS DISTINCT FROM CASE type WHEN 'email' THEN 'EmailPersonIdentity' WHEN 'phone' THEN 'PhonePersonIdentity' END")} AS n_wrong_class,
  {count_if("type IS DISTINCT FROM CASE WHEN value LIKE '%linkedin.com%' THEN 'linkedin' WHEN value LIKE '%@%' THEN 'email' WHEN length(regexp_replace(value, '[^0-9]', '', 'g')) > 3 THEN 'phone' END")} AS n_wrong_shape
FROM {_MIXED} GROUP BY type""")
def _(t: Tables):
    from rosterlift.functions.contact import email_norm
    rows = t.contacts.select(F.expr("CASE WHEN id % 5 = 0 THEN 'phone' ELSE 'email' END").alias("type"),
                             F.expr("CASE WHEN id % 7 = 0 THEN 'PhonePersonIdentity' ELSE 'EmailPersonIdentity' END").alias("class_type"), email_norm("email").alias("value"))
    return integrity.type_mismatches(rows, identities.CLASS_TYPES)


@query("k05_several_values", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (regexp_matches({c}, '[,;|/\\n\\t]')) AS n_bad FROM {CONTACTS}" for c in ("phone", "mobile", "list_text"))
       + " UNION ALL " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (regexp_matches({c}, '[,;|\n\t]')) AS n_bad FROM {CONTACTS}" for c in ("website", "linkedin")))
def _(t: Tables):
    return integrity.several_values(t.contacts, ["phone", "mobile", "list_text", "website", "linkedin"], urls=["website", "linkedin"])


def _d_digits(x: str) -> str:
    from .column_queries import d_phone
    return d_phone(x)


@query("k05_split_values", f"""
SELECT DISTINCT id AS person_id, 'phone' AS type, {_d_digits('item')} AS value FROM (SELECT id, trim(unnest(regexp_split_to_array(phone, '[,;/|\\n\\t]'))) AS item FROM {CONTACTS} WHERE phone IS NOT NULL)
WHERE item <> '' AND {_d_digits('item')} IS NOT NULL""")
def _(t: Tables):
    return identities.build_listed_identities(t.contacts.withColumn("person_id", F.col("id")), "phone", "phone")


_CHANGED = f"(SELECT id, CASE WHEN id % 10 = 0 THEN NULL WHEN id % 7 = 0 THEN 'x' || {d_email('email')} ELSE {d_email('email')} END AS email FROM {CONTACTS})"


@query("k06_lost_values", f"""
SELECT 'email' AS column_name, {count_if('s.e IS NOT NULL AND t.email IS NULL')} AS n_lost, {count_if('s.e <> t.email')} AS n_changed FROM (SELECT id, {d_email('email')} AS e FROM {CONTACTS}) s JOIN {_CHANGED} t ON t.id = s.id""")
def _(t: Tables):
    from rosterlift.functions.contact import email_norm
    arrived = t.contacts.select("id", F.when(F.col("id") % 10 == 0, F.lit(None)).when(F.col("id") % 7 == 0, F.concat(F.lit("x"), email_norm("email"))).otherwise(email_norm("email")).alias("email"))
    return integrity.lost_values(t.contacts, arrived, "id", {"email": email_norm("email")})


@query("k07_unmapped_codes", f"SELECT lower(trim(status)) AS code, count(*) AS n_rows FROM {APPS} WHERE lower(trim(status)) NOT IN ({', '.join(repr(k) for k in STATUS)}) GROUP BY 1")
def _(t: Tables):
    return integrity.unmapped_codes(t.applications, F.lower(F.trim("status")), list(STATUS))


@query("k08_repeated_identities", f"SELECT owner_id, lower(email) AS value, count(*) AS n_rows FROM {CONTACTS} GROUP BY 1, 2 HAVING count(*) > 1")
def _(t: Tables):
    return integrity.repeated_identities(t.contacts.selectExpr("owner_id", "email AS value"), "owner_id")


@query("k09_user_policies", f"""
SELECT p.id, 'master' AS policy, coalesce(u.atlas_id, '{CTX.master_id}') AS who FROM {POSTINGS} p LEFT JOIN {USERS} u ON u.id = p.owner_id
UNION ALL SELECT p.id, 'map', coalesce(u.atlas_id, CASE p.owner_id WHEN 3 THEN 'hand-3' END, '{CTX.master_id}') FROM {POSTINGS} p LEFT JOIN {USERS} u ON u.id = p.owner_id
UNION ALL SELECT p.id, 'exclude', u.atlas_id FROM {POSTINGS} p JOIN {USERS} u ON u.id = p.owner_id""")
def _(t: Tables):
    rows = t.postings.select("id", "owner_id")
    parts = [integrity.map_users(rows, "owner_id", t.users, "who", p, CTX.master(), {"3": "hand-3"}).select("id", F.lit(p).alias("policy"), "who") for p in ("master", "map", "exclude")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# -- comparison ------------------------------------------------------------------------------------------------

_LEFT = "(SELECT o_orderkey AS id, o_custkey AS company_id, o_orderstatus AS state, o_orderpriority AS kind FROM orders)"
_RIGHT = """(SELECT o_orderkey AS id, CASE WHEN o_orderkey % 101 = 0 THEN o_custkey + 1 ELSE o_custkey END AS company_id, CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE o_orderstatus END AS state, o_orderpriority || ' ' AS kind
  FROM orders WHERE o_orderkey % 97 <> 0 UNION ALL SELECT o_orderkey + 100000000, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 500 = 0)"""


def _sides(t: Tables):
    left = t.orders.selectExpr("o_orderkey AS id", "o_custkey AS company_id", "o_orderstatus AS state", "o_orderpriority AS kind")
    right = t.orders.where("o_orderkey % 97 <> 0").selectExpr(
        "o_orderkey AS id", "CASE WHEN o_orderkey % 101 = 0 THEN o_custkey + 1 ELSE o_custkey END AS company_id", "CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE o_orderstatus END AS state", "o_orderpriority || ' ' AS kind")
    extra = t.orders.where("o_orderkey % 500 = 0").selectExpr("o_orderkey + 100000000 AS id", "o_custkey AS company_id", "o_orderstatus AS state", "o_orderpriority AS kind")
    return left, right.unionByName(extra)


@query("c02_row_counts", f"SELECT a.n AS n_left, b.n AS n_right, abs(a.n - b.n) AS difference FROM (SELECT count(*) AS n FROM {_LEFT}) a, (SELECT count(*) AS n FROM {_RIGHT}) b")
def _(t: Tables):
    return diff.count_difference(*_sides(t))


@query("c03_key_diff", f"""
SELECT coalesce(l.id, r.id) AS key, CASE WHEN r.id IS NULL THEN 'only_left' ELSE 'only_right' END AS difference, CASE WHEN l.id IS NULL THEN 0 ELSE 1 END AS n_left, CASE WHEN r.id IS NULL THEN 0 ELSE 1 END AS n_right
FROM {_LEFT} l FULL JOIN {_RIGHT} r ON r.id = l.id WHERE l.id IS NULL OR r.id IS NULL""")
def _(t: Tables):
    left, right = _sides(t)
    return diff.key_diff(left, right, diff.likely_key(left, right))


_DIFFERS = {c: f"trim(CAST(l.{c} AS VARCHAR)) IS DISTINCT FROM trim(CAST(r.{c} AS VARCHAR))" for c in ("company_id", "kind", "state")}


@query("c04_field_diff", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {count_if(d)} AS n_different, round(100.0 * {count_if(d)} / count(*), 2) AS percent FROM {_LEFT} l JOIN {_RIGHT} r ON r.id = l.id" for c, d in _DIFFERS.items()) + ") WHERE n_different > 0")
def _(t: Tables):
    return diff.field_diff(*_sides(t), "id")


_SAMPLES = ("SELECT key, column_name, left_value, right_value, CAST(n AS INT) AS n FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY key) AS n FROM (" + " UNION ALL ".join(
    f"SELECT l.id AS key, '{c}' AS column_name, CAST(l.{c} AS VARCHAR) AS left_value, CAST(r.{c} AS VARCHAR) AS right_value FROM {_LEFT} l JOIN {_RIGHT} r ON r.id = l.id WHERE {d}" for c, d in _DIFFERS.items()) + ")) WHERE n <= 5")


@query("c04_field_samples", _SAMPLES)
def _(t: Tables):
    return diff.field_samples(*_sides(t), "id")


@query("c04_samples_by_digest", _SAMPLES)
def _(t: Tables):
    """The same, from buckets whose digests differ."""
    left, right = _sides(t)
    return diff.field_samples(*diff.differing_rows(left, right, "id"), "id")


@query("c05_multiset_diff", """
SELECT a AS l_suppkey, b AS l_returnflag, n_left, n_right FROM (SELECT l_suppkey AS a, l_returnflag AS b, count(*) AS n_left, count(*) FILTER (l_linenumber % 7 <> 0) AS n_right FROM lineitem GROUP BY 1, 2) WHERE n_left <> n_right""")
def _(t: Tables):
    rows = t.lineitem.select("l_suppkey", "l_returnflag", "l_linenumber")
    return diff.multiset_diff(rows.drop("l_linenumber"), rows.where("l_linenumber % 7 <> 0").drop("l_linenumber"))


@query("c06_summary", f"""
SELECT abs((SELECT count(*) FROM {_LEFT}) - (SELECT count(*) FROM {_RIGHT})) AS row_count_difference, {count_if('r.id IS NULL')} AS n_only_left, {count_if('l.id IS NULL')} AS n_only_right,
  {count_if('l.id = r.id')} AS n_common, {count_if('l.id = r.id AND (' + ' OR '.join(_DIFFERS.values()) + ')')} AS n_rows_different,
  {' + '.join(f'max(CASE WHEN l.id = r.id AND {d} THEN 1 ELSE 0 END)' for d in _DIFFERS.values())} AS n_columns_different, 0 AS n_type_differences FROM {_LEFT} l FULL JOIN {_RIGHT} r ON r.id = l.id""")
def _(t: Tables):
    return diff.diff_summary(*_sides(t), "id")
