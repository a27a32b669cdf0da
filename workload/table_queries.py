"""Canonical tables built from the test tables, against the model SQL they stand for."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterlift.functions.codes import code_groups, code_map
from rosterlift.functions.dates import iso
from rosterlift.operators import chains, joins, reshape
from rosterlift.operators.history import outcome, project_state
from rosterlift.plans import (attributes, candidates, career, companies, corrections, fees, files, identities, notes,
                              opportunities, people, projects, salaries)

from .base import CTX, NOW, Tables, id_sql, query, src, uuid_sql
from .column_queries import (d_clean_html, d_email, d_iso, d_linkedin, d_locality, d_markdown, d_number, d_personal, d_phone,
                             d_range, d_scrub, d_stamp, d_tags, d_website)
from .history_queries import CLOSE_REASONS, PROJECT_STATES

(CONTACTS, PEOPLE, COMPANIES, PROJECTS, USERS, APPS, POSTINGS, COMMENTS, HISTORY, STAGES, STAFF, PRIOR, A_SIDE, B_SIDE, ROWS,
 PARTS, TEXTS) = (src(n) for n in (
     "contacts", "people", "companies", "projects", "users", "applications", "postings", "comments", "history", "stages", "staff",
     "prior_users", "candidate_people", "contact_people", "people_rows", "attribute_rows", "id_texts"))
MASTER, AGENCY, MIDNIGHT = CTX.master_id, CTX.agency_id, CTX.midnight_iso
COUNTRY = "CASE country_id WHEN 1 THEN 'United States' WHEN 2245 THEN 'France' WHEN 2359 THEN 'United Kingdom' END"
DUPES = "(SELECT s_suppkey AS contact_id, s_suppkey + 1 AS candidate_id FROM supplier WHERE s_suppkey % 6 = 0)"

RELATIONSHIPS = {"client": ["active", "terms signed"], "none": ["archive", "passive", "prospect"]}
RESTRICTIONS = {"NO": "hard", "DO NOT SOURCE": "hard", "SOURCE WITH CARE": "soft"}
CONTACT_RELATIONSHIPS = {"Client": "client", "Active": "client", "Prospect": "prospect", "prospect": "prospect", "Imported": "prospect"}
CONTRACTS = {"1-URGENT": "contract", "2-HIGH": "contract", "3-MEDIUM": "full_time"}
STATUS = {"placed": "Hired", "1st interview": "Client IV", "interview/rejected": "Client IV", "offer rejected": "Offer",
          "cv sent": "Presented", "screened": "Internal IV"}
REJECTION = {"rejected": "by_us", "offer rejected": "self", "candidate not interested": "self", "client rejected": "by_client",
             "interview/rejected": "by_client"}
REASON = {"offer rejected": "accepted_another_offer", "client rejected": "not_qualified"}


def sql_map(code: str, mapping: dict[str, str], default: str | None = None) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {code} {arms} ELSE {'NULL' if default is None else repr(default)} END"


def sql_groups(code: str, groups: dict[str, list[str]], default: str) -> str:
    return sql_map(f"lower(trim({code}))", {c: r for r, cs in groups.items() for c in cs}, default)


def marks():
    return outcome(F.lower(F.trim("status")), STATUS, REJECTION, REASON, iso("added_at"))


def dupes(t: Tables):
    return t.supplier.where("s_suppkey % 6 = 0").selectExpr("s_suppkey AS contact_id", "s_suppkey + 1 AS candidate_id")


_REPAIRED = ("CASE WHEN email LIKE '%@%' THEN regexp_replace(lower(trim(email)), '^([^@]+)-([^@]+\\.[^@]+)$', '\\1@\\2') "
             "ELSE regexp_replace(lower(trim(email)), '^([^-]+)-([^-]+.*)$', '\\1@\\2') END")


@query("e01_users", f"""
WITH ranked AS (SELECT id, {id_sql('id')} AS uid, first_name || ' ' || last_name AS nm, {d_iso('added_at', '%Y-%m-%dT00:00:00Z')} AS created_at,
  {d_iso('modified_at')} AS updated_at, {_REPAIRED} AS mail, row_number() OVER (PARTITION BY {_REPAIRED} ORDER BY added_at DESC, id) AS rn
  FROM {STAFF} WHERE lower(email) LIKE '%corp.example.com%')
SELECT r.id, coalesce(p.atlas_id, r.uid) AS atlas_id, coalesce(nullif(trim(p.name), ''), nullif(trim(r.nm), ''), r.mail) AS name, r.created_at, r.updated_at,
  r.mail AS email, coalesce(p.status, 'disabled') AS status FROM ranked r LEFT JOIN {PRIOR} p ON lower(r.mail) = lower(p.email) WHERE r.rn = 1""")
def _(t: Tables):
    return people.build_users(t.staff, CTX, t.prior_users)


@query("e02_import_scope", "SELECT s_suppkey AS person_id FROM supplier WHERE s_suppkey IN (SELECT user_id FROM events WHERE event_type = 'signup') OR s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R')")
def _(t: Tables):
    activity = [(t.events.where("event_type = 'signup'"), "user_id"), (t.lineitem.where("l_returnflag = 'R'"), "l_suppkey")]
    return people.import_scope(t.supplier, "s_suppkey", activity, "person_id")


@query("e03_duplicate_map", f"SELECT id AS contact_id, linked_id AS candidate_id FROM {CONTACTS} WHERE linked_id IS NOT NULL AND id IN (SELECT o_custkey FROM orders)")
def _(t: Tables):
    return people.duplicate_people(t.contacts, t.orders, "o_custkey")


def d_survivors(links: str, duplicate: str, survivor: str) -> str:
    """The end of each duplicate's chain of links, by walking it; the smallest member of a cycle ends it."""
    return f"""(WITH RECURSIVE one AS (SELECT {duplicate} AS id, min({survivor}) AS nxt FROM {links} WHERE {duplicate} <> {survivor} GROUP BY {duplicate}),
walk AS (SELECT id, nxt AS here, [id] AS path FROM one
  UNION ALL SELECT w.id, o.nxt, list_append(w.path, w.here) FROM walk w JOIN one o ON o.id = w.here WHERE NOT list_contains(w.path, w.here)),
ended AS (SELECT id, list_contains(path, here) AS in_cycle,
  CASE WHEN list_contains(path, here) THEN list_min(path[list_position(path, here):]) ELSE here END AS last FROM walk
  WHERE list_contains(path, here) OR here NOT IN (SELECT id FROM one))
SELECT id AS {duplicate}, last AS {survivor}, in_cycle FROM ended WHERE id <> last)"""


# Chains of five links, cycles of four with two rows leading into them, and one survivor that many rows share.
_MERGES = ("(SELECT c_custkey AS contact_id, CASE WHEN c_custkey % 30 BETWEEN 1 AND 5 OR c_custkey % 30 BETWEEN 11 AND 15 THEN c_custkey - 1 "
           "WHEN c_custkey % 30 = 10 THEN c_custkey + 3 WHEN c_custkey % 30 >= 20 THEN 5 END AS candidate_id, c_name AS email FROM customer)")


def _merges(t: Tables):
    link = _MERGES.removeprefix("(SELECT c_custkey AS contact_id, ").removesuffix(" AS candidate_id, c_name AS email FROM customer)")
    return t.customer.selectExpr("c_custkey AS contact_id", f"{link} AS candidate_id", "c_name AS email")


@query("e03_survivor_chains", f"SELECT * FROM {d_survivors(_MERGES, 'contact_id', 'candidate_id')}")
def _(t: Tables):
    return chains.survivors(_merges(t))


@query("e03_people_of_chains", f"""
SELECT o.o_orderkey AS id, coalesce(s.candidate_id, o.o_custkey) AS person_id FROM orders o
LEFT JOIN {d_survivors(_MERGES, 'contact_id', 'candidate_id')} s ON s.contact_id = o.o_custkey""")
def _(t: Tables):
    ends = chains.survivors(_merges(t))
    rows = joins.survivor_key(t.orders.selectExpr("o_orderkey AS id", "o_custkey AS person_id"), "person_id", ends)
    # Nobody is lost: survivors are what is left of the people once the duplicates are excluded.
    left = joins.exclude(t.customer.selectExpr("c_custkey AS id"), "id", ends, "contact_id", unique=True)
    return joins.drop_orphans(rows, "person_id", left)


_STREET = f"CASE WHEN nullif(a1, '') IS NOT NULL AND nullif(a2, '') IS NOT NULL THEN a1 || ', ' || a2 WHEN nullif(a1, '') IS NOT NULL THEN a1 WHEN nullif(a2, '') IS NOT NULL THEN a2 END"


@query("e04_people", f"""
WITH base AS (SELECT *, {d_scrub('address1')} AS a1, {d_scrub('address2')} AS a2 FROM {ROWS}),
dupes AS (SELECT id AS contact_id FROM base WHERE linked_id IS NOT NULL AND id IN (SELECT user_id FROM events))
SELECT {id_sql('id')} AS atlas_id, id, first_name, last_name, {d_iso('modified_at')} AS updated_at, {d_iso('added_at')} AS created_at, 'regular' AS candidate_status,
  'active' AS responsiveness, {_STREET} AS location_street_address, {d_scrub('city')} AS location_locality, {d_scrub('state')} AS location_region,
  {d_scrub('zip')} AS location_postal_code, {d_scrub('country')} AS location_country, NULL AS created_by_id, NULL AS updated_by_id, '{MASTER}' AS created_by_atlas_id,
  '{MASTER}' AS updated_by_atlas_id, '{AGENCY}' AS agency_id FROM base
WHERE id IN (SELECT l_suppkey FROM lineitem) AND id NOT IN (SELECT contact_id FROM dupes) AND id NOT IN (SELECT id FROM {USERS})""")
def _(t: Tables):
    scope = t.lineitem.select(F.col("l_suppkey").alias("person_id"))
    doubles = people.duplicate_people(t.people_rows, t.events, "user_id")
    return people.build_people(t.people_rows, CTX, scope, doubles, t.users)


_SAME = ("(lower(nullif(trim(cd.email), '')) = lower(nullif(trim(ct.email), '')) OR nullif(trim(cd.phone), '') = nullif(trim(ct.phone), '') "
         "OR lower(nullif(trim(cd.linkedin), '')) = lower(nullif(trim(ct.linkedin), '')))")


@query("e04_people_two_lists", f"""
WITH a AS (SELECT cd.id, cd.id AS candidate_id, min(ct.id) AS contact_id, any_value(cd.first_name) AS first_name, any_value(cd.last_name) AS last_name,
    any_value(cd.created_on) AS created_at, any_value(cd.updated_on) AS updated_at, any_value(cd.created_by) AS created_by_id, any_value(cd.street) AS street,
    any_value(cd.street) AS place, any_value(cd.city) AS metro, any_value(cd.state) AS region, any_value(cd.country) AS country
  FROM {A_SIDE} cd LEFT JOIN {B_SIDE} ct ON {_SAME} GROUP BY cd.id),
b AS (SELECT 'cc' || ct.id AS id, CAST(NULL AS VARCHAR) AS candidate_id, ct.id AS contact_id, ct.first_name, ct.last_name, ct.created_on, ct.updated_on, ct.created_by,
    ct.street, trim(coalesce(ct.street, '') || ' ' || coalesce(ct.city, '') || ' ' || coalesce(ct.state, '')), ct.city, ct.state, ct.country
  FROM {B_SIDE} ct LEFT JOIN {A_SIDE} cd ON {_SAME} WHERE cd.id IS NULL),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT id, candidate_id, contact_id, first_name, last_name, {uuid_sql('id')} AS atlas_id, created_at, updated_at, created_by_id, {uuid_sql('created_by_id')} AS created_by_atlas_id,
  created_by_id AS updated_by_id, {uuid_sql('created_by_id')} AS updated_by_atlas_id, 'active' AS responsiveness, 'regular' AS candidate_status, street AS location_street_address,
  CASE WHEN coalesce(place, '') = '' THEN trim(metro || ' ' || country) ELSE place END AS location_locality, metro AS location_metro, region AS location_region,
  country AS location_country, '{AGENCY}' AS agency_id FROM u""")
def _(t: Tables):
    return people.build_people_from_two_lists(t.candidate_people, t.contact_people, CTX)


def _sect(label: str, c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL AND trim({c}) != '' THEN '{label}' || trim({c}) END"


@query("e05_overview", f"""
SELECT x.id, x.overview, c.atlas_id AS atlas_person_id FROM (SELECT id, concat_ws(chr(13) || chr(10), {_sect('Note: ', 'html')}, {_sect('City: ', 'city')}) AS overview FROM {CONTACTS}) x
JOIN {COMPANIES} c ON c.id = x.id WHERE x.overview <> ''""")
def _(t: Tables):
    return people.people_overview(t.contacts, t.companies, [("Note: ", "html"), ("City: ", "city")])


_MAIL = f"coalesce(nullif({d_email('email')}, ''), nullif({d_email('email2')}, ''))"
_PROFILE = f"coalesce(nullif({d_linkedin('linkedin')}, ''), nullif({d_linkedin('linkedin2')}, ''))"
_CLASS = "CASE type WHEN 'email' THEN 'EmailPersonIdentity' WHEN 'phone' THEN 'PhonePersonIdentity' WHEN 'linkedin' THEN 'LinkedinPersonIdentity' END AS class_type"
_TAIL = f"""'{AGENCY}' AS agency_id, '{MASTER}' AS created_by_id, 'migration' AS source, FALSE AS hidden, FALSE AS bounced, TRUE AS active, favourite, TRUE AS verified,
  '{NOW}' AS created_at, '{NOW}' AS updated_at, {uuid_sql('atlas_person_id', 'type', 'value')} AS atlas_id, inactive_reason"""


def _phone_branch(field: str) -> str:
    kind = "corporate" if field == "workphone" else "personal"
    return (f"SELECT person_id, atlas_person_id, 'phone' AS type, {d_phone(field)} AS value, '{kind}' AS scope, {str(field == 'mobile').upper()} AS favourite, "
            f"'{field}' AS f, NULL AS inactive_reason, {d_phone(field)} AS key FROM src WHERE length({d_phone(field)}) > 3")


_IDENTITY_SRC = f"""src AS (
  SELECT c.*, c.id AS person_id, p.atlas_id AS atlas_person_id FROM {CONTACTS} c JOIN {PEOPLE} p ON p.id = c.id WHERE c.id NOT IN (SELECT contact_id FROM {DUPES})
  UNION ALL SELECT c.*, p.id AS person_id, p.atlas_id FROM {CONTACTS} c JOIN {DUPES} d ON d.contact_id = c.id JOIN {PEOPLE} p ON p.id = d.candidate_id)"""


@query("e06_person_identities", f"""
WITH {_IDENTITY_SRC},
raw AS (
  SELECT person_id, atlas_person_id, 'email' AS type, lower({_MAIL}) AS value, CASE WHEN has_company THEN 'corporate' WHEN {d_personal(_MAIL)} THEN 'personal' ELSE 'corporate' END AS scope,
    (NOT has_company AND {d_personal(_MAIL)}) AS favourite, 'email' AS f, CASE WHEN email_status = 2 THEN 'unsubscribed' END AS inactive_reason, lower({_MAIL}) AS key
  FROM src WHERE {_MAIL} LIKE '%@%' AND length(trim({_MAIL})) > 3
  UNION ALL SELECT person_id, atlas_person_id, 'linkedin', lower({_PROFILE}), NULL, FALSE, 'linkedin', NULL, {_PROFILE} FROM src WHERE {_PROFILE} LIKE '%linkedin.com%'
  UNION ALL {_phone_branch('phone')} UNION ALL {_phone_branch('phone2')} UNION ALL {_phone_branch('mobile')} UNION ALL {_phone_branch('workphone')}),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY type, value ORDER BY (scope IS NULL OR scope = '') ASC, person_id, f, key) AS rn FROM raw) WHERE rn = 1)
SELECT atlas_person_id, person_id, type, value, scope AS identity_type_type, {_CLASS}, {_TAIL.replace(uuid_sql('atlas_person_id', 'type', 'value'), uuid_sql('atlas_person_id', 'type', 'key'))} FROM one""")
def _(t: Tables):
    raw = t.contacts.withColumn("person_id", F.col("id"))
    return identities.build_person_identities(raw, t.people, CTX, dupes(t))


@query("e07_unique_owner_identities", f"""
WITH v AS (SELECT id AS person_id, 'email' AS type, email AS value FROM {CONTACTS} WHERE email IS NOT NULL AND trim(email) <> ''
  UNION ALL SELECT id, 'phone', {d_phone('phone')} FROM {CONTACTS} UNION ALL SELECT id, 'phone', {d_phone('mobile')} FROM {CONTACTS}
  UNION ALL SELECT id, 'linkedin', regexp_replace(linkedin, '^(https?://)?(www\\.)?', '') FROM {CONTACTS} WHERE linkedin IS NOT NULL AND trim(linkedin) <> ''),
once AS (SELECT type, value, min(person_id) AS person_id FROM v WHERE value IS NOT NULL GROUP BY type, value HAVING count(*) = 1),
o AS (SELECT o.*, p.atlas_id AS atlas_person_id, NULL AS inactive_reason, TRUE AS favourite FROM once o JOIN {COMPANIES} p ON p.id = o.person_id)
SELECT atlas_person_id, person_id, type, value, CASE WHEN type <> 'email' OR {d_personal('value')} THEN 'personal' ELSE 'corporate' END AS identity_type_type, {_CLASS},
  {_TAIL.replace(uuid_sql('atlas_person_id', 'type', 'value'), uuid_sql('value'))} FROM o""")
def _(t: Tables):
    return identities.build_unique_owner_identities(t.contacts.withColumn("person_id", F.col("id")), t.companies, CTX)


_GENERIC = "CASE id % 4 WHEN 0 THEN email WHEN 1 THEN phone WHEN 2 THEN linkedin ELSE website END"
_KIND = ("CASE WHEN lower(v) LIKE '%linkedin.com%' THEN 'linkedin' WHEN v LIKE '%@%' THEN 'email' WHEN lower(trim(v)) LIKE 'http://%' OR lower(trim(v)) LIKE 'https://%' "
         "OR lower(trim(v)) LIKE 'www.%' THEN 'website' WHEN length(regexp_replace(v, '[^0-9]', '', 'g')) > 3 THEN 'phone' END")


@query("e06_routed_identities", f"""
WITH k AS (SELECT id, {_KIND} AS type, v FROM (SELECT id, {_GENERIC} AS v FROM {CONTACTS})),
n AS (SELECT k.id, k.id AS person_id, p.atlas_id AS atlas_person_id, type, CASE type WHEN 'email' THEN {d_email('v')} WHEN 'phone' THEN {d_phone('v')} WHEN 'linkedin' THEN lower({d_linkedin('v')}) END AS value
      FROM k JOIN {COMPANIES} p ON p.id = k.id),
o AS (SELECT *, FALSE AS favourite, NULL AS inactive_reason, row_number() OVER (PARTITION BY type, value ORDER BY id) AS rn FROM n WHERE value IS NOT NULL)
SELECT atlas_person_id, person_id, type, value, CASE WHEN type = 'email' AND NOT {d_personal('value')} THEN 'corporate' ELSE 'personal' END AS identity_type_type, {_CLASS}, {_TAIL} FROM o WHERE rn = 1""")
def _(t: Tables):
    raw = t.contacts.select("id", F.col("id").alias("person_id"), F.expr(_GENERIC).alias("value"))
    return identities.build_routed_identities(raw, t.companies, CTX)


@query("e06_two_stage_identities", f"""
WITH r AS (SELECT CAST(floor(id / 8) AS BIGINT) AS person_id, 'email' AS type, lower(trim(email)) AS value, CASE WHEN has_company THEN 'personal' ELSE 'corporate' END AS scope FROM {CONTACTS} WHERE trim(email) <> ''
  UNION ALL SELECT CAST(floor(id / 8) AS BIGINT), 'phone', {d_phone('phone')}, CASE WHEN has_company THEN 'personal' ELSE 'corporate' END FROM {CONTACTS} WHERE {d_phone('phone')} IS NOT NULL
  UNION ALL SELECT CAST(floor(id / 8) AS BIGINT), 'linkedin', {d_phone('mobile')}, 'personal' FROM {CONTACTS} WHERE {d_phone('mobile')} IS NOT NULL),
a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY person_id, type, value ORDER BY scope DESC) AS r1 FROM r) WHERE r1 = 1),
f AS (SELECT *, type IN ('email', 'phone') AND row_number() OVER (PARTITION BY person_id, type ORDER BY value) = 1 AS favourite FROM a)
SELECT person_id, type, value, scope, favourite FROM (SELECT *, row_number() OVER (PARTITION BY value ORDER BY CASE WHEN type = 'email' THEN 1 WHEN type = 'phone' THEN 2 ELSE 3 END,
  CASE WHEN scope = 'personal' THEN 1 ELSE 2 END, person_id, type) AS r2 FROM f) WHERE r2 = 1""")
def _(t: Tables):
    from rosterlift.functions.contact import phone_norm
    scope = F.when(F.col("has_company"), "personal").otherwise("corporate")
    branches = [{"type": F.lit("email"), "value": F.nullif(F.lower(F.trim("email")), F.lit("")), "scope": scope},
                {"type": F.lit("phone"), "value": phone_norm("phone"), "scope": scope},
                {"type": F.lit("linkedin"), "value": phone_norm("mobile"), "scope": F.lit("personal")}]
    rows = reshape.unpivot(t.contacts.withColumn("person_id", F.floor(F.col("id") / 8)), ["person_id"], branches)
    return identities.two_stage_identities(rows)


@query("e08_companies", f"""
SELECT {id_sql('id')} AS atlas_id, id, name, {d_markdown('html')} AS summary, {sql_groups('status', RELATIONSHIPS, 'none')} AS relationship, {d_scrub('address1')} AS location_street_address,
  {d_scrub('city')} AS location_metro, {d_scrub('state')} AS location_region, {d_scrub('zip')} AS location_postal_code, {d_scrub(COUNTRY)} AS location_country,
  {d_locality('address1', 'address2', 'city', 'state', 'zip', d_scrub(COUNTRY))} AS location_locality, {d_iso('added_at')} AS created_at, {d_iso('modified_at')} AS updated_at,
  CASE WHEN restriction IN ('NO', 'DO NOT SOURCE') THEN 'hard' WHEN restriction = 'SOURCE WITH CARE' THEN 'soft' ELSE 'none' END AS restriction_type, {d_range('headcount')} AS size, '{AGENCY}' AS agency_id
FROM {CONTACTS} WHERE name <> 'Prince' AND name IS NOT NULL AND trim(name) <> '' AND id IN (SELECT o_custkey FROM orders)""")
def _(t: Tables):
    from rosterlift.functions.codes import country_name
    raw = t.contacts.withColumnRenamed("html", "description").withColumn("country", country_name("country_id"))
    return companies.build_companies(raw, CTX, code_groups("status", RELATIONSHIPS, "none"), code_map("restriction", RESTRICTIONS, "none"), "Prince", t.orders.selectExpr("o_custkey AS company_id"))


@query("e09_company_identities", f"""
WITH s AS (SELECT id AS company_id, nullif(trim(phone), '') AS phone, {d_website('website')} AS website, {d_linkedin('linkedin')} AS linkedin FROM {CONTACTS}),
r AS (SELECT company_id, 'phone' AS type, phone AS value, FALSE AS is_primary FROM s WHERE length(phone) > 6
  UNION ALL SELECT company_id, 'website', website, TRUE FROM s WHERE website LIKE '%.%' AND website NOT LIKE '%linkedin.com%'
  UNION ALL SELECT company_id, 'linkedin', linkedin, FALSE FROM s WHERE linkedin LIKE '%linkedin.com%')
SELECT atlas_id, company_id, atlas_company_id, type, value, is_primary, '{NOW}' AS created_at, '{NOW}' AS updated_at FROM (
  SELECT r.*, c.atlas_id AS atlas_company_id, {id_sql('r.company_id', 'r.type', 'r.value')} AS atlas_id, row_number() OVER (PARTITION BY type, value ORDER BY company_id) AS rn
  FROM r JOIN {COMPANIES} c ON c.id = r.company_id) WHERE rn = 1""")
def _(t: Tables):
    return identities.build_company_identities(t.contacts.withColumn("company_id", F.col("id")), t.companies, CTX)


_CLIENTS = f"(SELECT id, owner_id * 4 AS person_id, id AS company_id, status, nullif(city, '') AS title, added_at FROM {CONTACTS})"


@query("e10_company_contacts", f"""
WITH b AS (SELECT bh.id, p.id AS person_id, p.atlas_id AS atlas_person_id, bh.company_id, c.atlas_id AS atlas_company_id, bh.status, bh.title, bh.added_at FROM {_CLIENTS} bh
    JOIN {COMPANIES} c ON c.id = bh.company_id JOIN {DUPES} d ON d.contact_id = bh.person_id JOIN {PEOPLE} p ON p.id = d.candidate_id
  UNION ALL SELECT bh.id, p.id, p.atlas_id, bh.company_id, c.atlas_id, bh.status, bh.title, bh.added_at FROM {_CLIENTS} bh JOIN {COMPANIES} c ON c.id = bh.company_id
    JOIN {PEOPLE} p ON p.id = bh.person_id WHERE bh.person_id NOT IN (SELECT contact_id FROM {DUPES}))
SELECT id, {id_sql("'companycontact'", 'id')} AS atlas_id, person_id, atlas_person_id, company_id, atlas_company_id, {d_iso('added_at')} AS created_at, {d_iso('added_at')} AS updated_at,
  {sql_map('status', CONTACT_RELATIONSHIPS, 'none')} AS relationship, coalesce(title, 'Missing Title') AS title, '{AGENCY}' AS agency_id
FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY added_at DESC, id) AS rn FROM b) WHERE rn = 1""")
def _(t: Tables):
    raw = t.contacts.selectExpr("id", "CAST(owner_id * 4 AS BIGINT) AS person_id", "id AS company_id", "status", "nullif(city, '') AS title", "added_at")
    return companies.build_company_contacts(raw, t.companies, t.people, CTX, code_map("status", CONTACT_RELATIONSHIPS, "none"), dupes(t))


_LINKS = "(SELECT DISTINCT l.l_suppkey AS person_id, o.o_custkey AS company_id FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)"
_POSITIONS = "(SELECT user_id AS person_id, event_id % 1500 AS company_id, event_type AS title, event_type <> 'error' AS is_active FROM events)"


@query("e10_contacts_from_projects", f"""
WITH held AS (SELECT person_id, company_id, min(title) AS title FROM {_POSITIONS} WHERE is_active GROUP BY 1, 2)
SELECT id, atlas_id, person_id, atlas_person_id, company_id, atlas_company_id, relationship, coalesce(title, 'Missing Title') AS title, '{AGENCY}' AS agency_id FROM (
  SELECT '{CTX.client}_' || CAST(l.person_id AS VARCHAR) || 'companycontact' || CAST(l.company_id AS VARCHAR) AS id,
    {uuid_sql(f"'{CTX.client}_'", 'l.person_id', "'companycontact'", 'l.company_id')} AS atlas_id, l.person_id, p.atlas_id AS atlas_person_id, l.company_id, c.atlas_id AS atlas_company_id,
    CASE WHEN h.person_id IS NOT NULL THEN 'client' ELSE 'none' END AS relationship, h.title,
    row_number() OVER (PARTITION BY l.person_id ORDER BY CASE WHEN h.person_id IS NOT NULL THEN 0 ELSE 1 END, l.company_id) AS rn
  FROM {_LINKS} l JOIN {PEOPLE} p ON p.id = l.person_id JOIN {COMPANIES} c ON c.id = l.company_id LEFT JOIN held h ON h.person_id = l.person_id AND h.company_id = l.company_id) WHERE rn = 1""")
def _(t: Tables):
    links = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr("l_suppkey AS person_id", "o_custkey AS company_id")
    positions = t.events.selectExpr("user_id AS person_id", "event_id % 1500 AS company_id", "event_type AS title", "event_type <> 'error' AS is_active")
    return companies.build_contacts_from_projects(links, positions, t.companies, t.people, CTX)


_CHILDREN = f"(SELECT id, CASE WHEN id % 4 = 0 THEN CAST(floor(id / 4) AS BIGINT) END AS parent_id, added_at, modified_at, 'nation_' || CAST(owner_id AS VARCHAR) AS created_by FROM {CONTACTS})"


@query("e11_company_relationships", f"""
SELECT {uuid_sql("'parent_'", 'p.atlas_id', "'_'", 's.atlas_id')} AS atlas_id, s.id AS subsidiary_id, p.id AS company_id, s.atlas_id AS atlas_subsidiary_id, p.atlas_id AS atlas_company_id,
  'parent' AS relationship_type, {d_iso('c.added_at', '%Y-%m-%dT%H:%M:%SZ')} AS created_at, {d_iso('c.modified_at', '%Y-%m-%dT%H:%M:%SZ')} AS updated_at,
  coalesce(u.atlas_id, '{MASTER}') AS created_by_atlas_id, '{AGENCY}' AS agency_id
FROM {_CHILDREN} c JOIN {COMPANIES} s ON s.id = c.id JOIN {COMPANIES} p ON p.id = c.parent_id LEFT JOIN {USERS} u ON lower(u.name) = lower(c.created_by)""")
def _(t: Tables):
    raw = t.contacts.selectExpr("id", "CASE WHEN id % 4 = 0 THEN id div 4 END AS parent_id", "added_at", "modified_at", "'nation_' || CAST(owner_id AS STRING) AS created_by")
    return companies.build_company_relationships(raw, t.companies, CTX, t.users)


_JOBS = f"""(SELECT id, person_id, CASE WHEN line = 3 THEN ' ' ELSE ' customer#' || lpad(CAST(project_id % 1600 AS STRING), 9, '0') || ' ' END AS company_name,
  CASE WHEN line = 5 THEN '' ELSE 'Title ' || flag END AS title, CASE WHEN line = 6 THEN NULL ELSE '19' || CAST(10 + project_id % 80 AS STRING) || '-01-01 00:00:00' END AS started_at,
  CASE WHEN line = 1 THEN NULL ELSE '2001-02-03 00:00:00' END AS finished_at, CASE line WHEN 2 THEN '<b>did</b> things' WHEN 4 THEN '' END AS description FROM {APPS})"""


def _jobs(t: Tables):
    return t.applications.selectExpr(
        "id", "person_id", "CASE WHEN line = 3 THEN ' ' ELSE ' customer#' || lpad(CAST(project_id % 1600 AS STRING), 9, '0') || ' ' END AS company_name",
        "CASE WHEN line = 5 THEN '' ELSE 'Title ' || flag END AS title",
        "CASE WHEN line = 6 THEN NULL ELSE '19' || CAST(10 + project_id % 80 AS STRING) || '-01-01 00:00:00' END AS started_at",
        "CASE WHEN line = 1 THEN NULL ELSE '2001-02-03 00:00:00' END AS finished_at", "CASE line WHEN 2 THEN '<b>did</b> things' WHEN 4 THEN '' END AS description")


_EXPERIENCES = f"""
WITH n AS (SELECT lower(trim(name)) AS k, min(id) AS id, min_by(atlas_id, id) AS atlas_id FROM {COMPANIES} GROUP BY 1),
s AS (SELECT * FROM {_JOBS} WHERE trim(company_name) <> '' AND started_at <> '' AND title <> ''),
r AS (SELECT s.* REPLACE (p.id AS person_id), p.atlas_id AS atlas_person_id FROM s JOIN {PEOPLE} p ON p.id = s.person_id WHERE s.person_id NOT IN (SELECT contact_id FROM {DUPES})
  UNION ALL SELECT s.* REPLACE (p.id AS person_id), p.atlas_id FROM s JOIN {DUPES} d ON d.contact_id = s.person_id JOIN {PEOPLE} p ON p.id = d.candidate_id),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY started_at DESC, person_id) AS rn FROM r) WHERE rn = 1)
"""


@query("e12_experiences", _EXPERIENCES + f"""
SELECT r.id, {id_sql('r.id')} AS atlas_id, '{NOW}' AS created_at, '{NOW}' AS updated_at, 'migration' AS source, '{AGENCY}' AS agency_id, left(started_at, 10) AS started_at,
  left(finished_at, 10) AS finished_at, trim(company_name) AS company_name, title, nullif({d_tags("coalesce(description, '')")}, '') AS description, person_id, atlas_person_id,
  n.id AS company_id, n.atlas_id AS atlas_company_id FROM one r LEFT JOIN n ON n.k = lower(trim(r.company_name))""")
def _(t: Tables):
    return career.build_experiences(_jobs(t), t.people, t.companies, CTX, dupes(t))


@query("e34_headline", _EXPERIENCES + """
SELECT person_id, atlas_person_id, title AS headline, trim(company_name) AS company_name, left(started_at, 10) AS started_at FROM (
  SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY (finished_at IS NULL) DESC, left(started_at, 10) DESC, id) AS h FROM one) WHERE h = 1""")
def _(t: Tables):
    return people.build_headlines(career.build_experiences(_jobs(t), t.people, t.companies, CTX, dupes(t)))


_STUDIES = f"""(SELECT id, person_id, CASE WHEN line = 2 THEN '' ELSE 'School ' || CAST(owner_id AS STRING) END AS school,
  CASE line WHEN 1 THEN 'BSc, Maths' WHEN 3 THEN 'MBA' WHEN 4 THEN 'BA, Arts, History ' END AS degree, CAST(line AS STRING) AS grade, '1990-09-01 00:00' AS started_at,
  CASE WHEN line > 4 THEN '1994-06-30' END AS finished_at FROM {APPS})"""


@query("e13_educations", f"""
SELECT r.id, {id_sql('r.id')} AS atlas_id, '{NOW}' AS created_at, '{NOW}' AS updated_at, 'migration' AS source, left(started_at, 10) AS started_at, left(finished_at, 10) AS finished_at, school AS name,
  trim(regexp_replace(nullif(trim(degree), ''), ',[^,]*$', '')) AS degree, CASE WHEN degree LIKE '%,%' THEN trim(regexp_extract(trim(degree), '([^,]*)$', 1)) END AS field_of_study, grade,
  person_id, p.atlas_id AS atlas_person_id
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY started_at DESC, person_id) AS rn FROM {_STUDIES} WHERE school <> '' AND person_id IN (SELECT id FROM {PEOPLE})) r
JOIN {PEOPLE} p ON p.id = r.person_id WHERE rn = 1""")
def _(t: Tables):
    raw = t.applications.selectExpr(
        "id", "person_id", "CASE WHEN line = 2 THEN '' ELSE 'School ' || CAST(owner_id AS STRING) END AS school",
        "CASE line WHEN 1 THEN 'BSc, Maths' WHEN 3 THEN 'MBA' WHEN 4 THEN 'BA, Arts, History ' END AS degree", "CAST(line AS STRING) AS grade",
        "'1990-09-01 00:00' AS started_at", "CASE WHEN line > 4 THEN '1994-06-30' END AS finished_at", "'' AS field_of_study")
    return career.build_educations(raw, t.people, CTX, split_degree=True)


_STATE = sql_groups("status", PROJECT_STATES, "closed")


def _letters(c: str) -> str:
    return f"CASE WHEN regexp_matches(trim({c}), '[a-zA-Z].*[a-zA-Z]') THEN trim({c}) END"


@query("e14_projects", f"""
WITH f AS (SELECT * FROM {POSTINGS} WHERE id NOT IN (SELECT DISTINCT linked_id FROM {POSTINGS} WHERE linked_id IS NOT NULL)),
s AS (SELECT f.*, c.atlas_id AS atlas_company_id, coalesce(u.atlas_id, '{MASTER}') AS atlas_owner_id, CASE WHEN f.added_at IS NULL THEN 'closed' ELSE {_STATE.replace('status', 'f.status')} END AS st
      FROM f JOIN {COMPANIES} c ON c.id = f.company_id LEFT JOIN {USERS} u ON u.id = f.owner_id)
SELECT {id_sql('id')} AS atlas_id, id, {d_iso('added_at')} AS created_at, {d_iso('added_at')} AS updated_at, CASE WHEN st = 'closed' THEN coalesce({d_iso('closed_at')}, {d_iso('added_at')}) END AS closed_at,
  title AS job_role, {sql_map('employment_type', CONTRACTS, 'full_time')} AS contract_type, salary, {d_tags('public_description')} AS job_description, {d_tags('description')} AS notes,
  owner_id, atlas_owner_id, company_id, atlas_company_id, st AS state, CASE WHEN st = 'closed' THEN {sql_groups('status', CLOSE_REASONS, 'worked_lost')} END AS close_reason,
  {d_locality('address1', 'address2', 'city', 'state', 'zip')} AS location_locality, {_letters('address1')} AS location_street_address, {_letters('city')} AS location_metro,
  {_letters('state')} AS location_region, CASE WHEN regexp_matches(trim(zip), '^[0-9]{{3,}}$') THEN trim(zip) END AS location_postal_code, id AS job_number, 'project' AS class_type FROM s""")
def _(t: Tables):
    return projects.build_projects(t.postings, t.companies, t.users, CTX, code_map("employment_type", CONTRACTS, "full_time"),
                                   project_state(F.col("status"), PROJECT_STATES, CLOSE_REASONS, iso("closed_at"), iso("added_at")))


@query("e14_unique_job_numbers", f"""
SELECT id, CASE WHEN row_number() OVER (PARTITION BY job_number ORDER BY created_at, id) = 1 THEN job_number END AS job_number
FROM (SELECT id, id % 900 AS job_number, {d_iso('added_at')} AS created_at FROM {POSTINGS})""")
def _(t: Tables):
    rows = t.postings.select("id", (F.col("id") % 900).alias("job_number"), iso("added_at").alias("created_at"))
    return projects.unique_job_numbers(rows).select("id", "job_number")


_HOLDERS = f"(SELECT id AS person_id, id + 5000000 AS id, {id_sql('id + 5000000')} AS atlas_id FROM {COMPANIES})"


@query("e15_project_company_contacts", f"""
SELECT x.id AS project_id, p.atlas_id AS atlas_project_id, x.contact_id AS person_id, cc.id AS company_contact_id, cc.atlas_id AS atlas_company_contact_id
FROM {POSTINGS} x JOIN {_HOLDERS} cc ON cc.person_id = x.contact_id JOIN {PROJECTS} p ON p.id = x.id""")
def _(t: Tables):
    from rosterlift.functions.ids import uuid_from
    key = F.col("id") + 5000000
    holders = t.companies.select(F.col("id").alias("person_id"), key.alias("id"), uuid_from("acme", F.lit("acme"), key).alias("atlas_id"))
    return projects.build_project_company_contacts(t.postings.selectExpr("id AS project_id", "contact_id AS person_id"), holders, t.projects)


@query("e16_project_users", f"""
WITH u AS (SELECT l_orderkey AS project_id, CAST(l_suppkey % 25 AS INT) AS user_id FROM lineitem UNION SELECT o_orderkey, CAST(o_custkey % 25 AS INT) FROM orders)
SELECT CAST(u.project_id AS VARCHAR) || '_' || CAST(u.user_id AS VARCHAR) AS id, {uuid_sql('u.project_id', 'u.user_id')} AS atlas_id, '{MIDNIGHT}' AS created_at, '{MIDNIGHT}' AS updated_at, '{AGENCY}' AS agency_id, u.project_id, p.atlas_id AS atlas_project_id, u.user_id, s.atlas_id AS atlas_user_id
FROM u JOIN {PROJECTS} p ON p.id = u.project_id JOIN {USERS} s ON s.id = u.user_id""")
def _(t: Tables):
    team = t.lineitem.selectExpr("l_orderkey AS project_id", "CAST(l_suppkey % 25 AS INT) AS user_id")
    owners = t.orders.selectExpr("o_orderkey AS project_id", "CAST(o_custkey % 25 AS INT) AS user_id")
    return projects.build_project_users(team, owners, t.projects, t.users, CTX)


_CODE = "lower(trim(status))"


@query("e17_candidates", f"""
WITH b AS (SELECT *, {sql_map(_CODE, STATUS, 'Added')} AS st, {sql_map(_CODE, REJECTION)} AS kind FROM {APPS}),
placed AS (SELECT id, max(added_at) AS hired FROM {APPS} WHERE {_CODE} = 'placed' GROUP BY id),
w AS (SELECT b.*, h.hired, pr.atlas_id AS atlas_project_id, pe.atlas_id AS atlas_person_id, coalesce(u.atlas_id, '{MASTER}') AS atlas_owner_id,
    row_number() OVER (PARTITION BY pr.atlas_id, pe.atlas_id ORDER BY b.added_at DESC, b.id DESC) AS rn
  FROM b LEFT JOIN placed h ON h.id = b.id AND b.st = 'Hired' JOIN {PROJECTS} pr ON pr.id = b.project_id LEFT JOIN {USERS} u ON u.id = b.owner_id JOIN {PEOPLE} pe ON pe.id = b.person_id)
SELECT id, {id_sql('id')} AS atlas_id, {d_iso('added_at')} AS created_at, {d_iso('added_at')} AS updated_at, project_id, atlas_project_id, person_id, atlas_person_id, 'Candidate' AS class_type,
  CASE WHEN kind IS NOT NULL THEN {d_iso('added_at')} END AS rejected_at, kind AS rejection_type,
  CASE {_CODE} WHEN 'offer rejected' THEN 'accepted_another_offer' WHEN 'client rejected' THEN 'not_qualified' ELSE CASE WHEN kind IS NOT NULL THEN 'other' END END AS rejection_reason,
  CASE WHEN kind IS NOT NULL THEN owner_id END AS rejected_by_id, CASE WHEN kind IS NOT NULL THEN atlas_owner_id END AS atlas_rejected_by_id, owner_id, atlas_owner_id, st AS status,
  {d_iso('hired')} AS hired_at FROM w WHERE rn = 1""")
def _(t: Tables):
    return candidates.build_candidates(t.applications, t.projects, t.people, t.users, CTX, marks(),
                                       t.applications.select("id", "status", "added_at"))


_E_STATUS = {"signup": "Internal IV", "view": "Presented", "purchase": "Hired"}
_E_REJECT = {"error": "by_us", "click": "by_client"}
_E_RAW = f"(SELECT l_orderkey * 10000000 + l_partkey * 100 + l_linenumber AS id, CAST(floor(l_orderkey / 10) AS BIGINT) AS person_id, l_orderkey AS project_id, CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_suppkey % 25 AS VARCHAR) ELSE 'NATION_' || CAST(l_suppkey % 25 AS VARCHAR) END AS owner, l_shipdate AS created_at, l_shipdate AS updated_at FROM lineitem)"


@query("e17_candidates_history", f"""
WITH h AS (SELECT * FROM {HISTORY}),
o AS (SELECT *, row_number() OVER (PARTITION BY person_id, project_id ORDER BY ts DESC, event_id DESC) AS rn FROM h), le AS (SELECT * FROM o WHERE rn = 1),
pv AS (SELECT h.person_id, h.project_id, h.status, row_number() OVER (PARTITION BY h.person_id, h.project_id ORDER BY h.ts DESC, h.event_id DESC) AS r2 FROM h
  JOIN le ON le.person_id = h.person_id AND le.project_id = h.project_id WHERE (h.ts, h.event_id) < (le.ts, le.event_id) AND h.status NOT IN ('error', 'click')),
m AS (SELECT le.person_id, le.project_id, {sql_map("CASE WHEN le.status IN ('error', 'click') THEN coalesce(pv.status, 'Added') ELSE le.status END", _E_STATUS, 'Added')} AS status,
    {sql_map('le.status', _E_REJECT)} AS kind, le.ts FROM le LEFT JOIN pv ON pv.person_id = le.person_id AND pv.project_id = le.project_id AND pv.r2 = 1)
SELECT r.id, {uuid_sql('r.id')} AS atlas_id, r.person_id, pe.atlas_id AS atlas_person_id, r.project_id, pr.atlas_id AS atlas_project_id, r.owner AS owner_id,
  coalesce(u1.atlas_id, u2.atlas_id, '{MASTER}') AS atlas_owner_id, {d_iso('r.created_at', '%Y-%m-%dT00:00:00')} AS created_at, {d_iso('r.updated_at', '%Y-%m-%dT00:00:00')} AS updated_at,
  coalesce(m.status, 'Added') AS status, m.kind AS rejection_type, CASE WHEN m.kind IS NOT NULL THEN 'other' END AS rejection_reason, CASE WHEN m.kind IS NOT NULL THEN '{MASTER}' END AS atlas_rejected_by_id,
  CASE WHEN m.kind IS NOT NULL THEN {d_iso('m.ts', '%Y-%m-%dT00:00:00')} END AS rejected_at
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY project_id, person_id ORDER BY created_at DESC NULLS LAST, id DESC) AS rn FROM {_E_RAW}) WHERE rn = 1) r LEFT JOIN m ON m.person_id = r.person_id AND m.project_id = r.project_id LEFT JOIN {USERS} u1 ON CAST(u1.id AS VARCHAR) = r.owner LEFT JOIN {USERS} u2 ON u2.name = r.owner
LEFT JOIN {PEOPLE} pe ON pe.id = r.person_id LEFT JOIN {PROJECTS} pr ON pr.id = r.project_id""")
def _(t: Tables):
    raw = t.lineitem.selectExpr(
        "l_orderkey * 10000000 + l_partkey * 100 + l_linenumber AS id", "floor(l_orderkey / 10) AS person_id", "l_orderkey AS project_id",
        "CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_suppkey % 25 AS STRING) ELSE 'NATION_' || CAST(l_suppkey % 25 AS STRING) END AS owner",
        "l_shipdate AS created_at", "l_shipdate AS updated_at")
    return candidates.build_candidates_from_history(raw, t.history, t.projects, t.people, t.users, CTX, _E_STATUS, _E_REJECT, ("error", "click"))


@query("e17_candidates_stages", f"""
WITH s AS (SELECT candidate_id AS person_id, project_id, 'Hired' AS status, hire AS ts FROM {STAGES} WHERE hire IS NOT NULL UNION ALL SELECT candidate_id, project_id, 'Internal IV', interview1 FROM {STAGES} WHERE interview1 IS NOT NULL
  UNION ALL SELECT candidate_id, project_id, 'Added', added FROM {STAGES}),
r AS (SELECT *, row_number() OVER (PARTITION BY person_id, project_id ORDER BY CASE status WHEN 'Hired' THEN 1 WHEN 'Internal IV' THEN 2 ELSE 3 END, ts DESC) AS rn FROM s)
SELECT CAST(r.person_id AS VARCHAR) || '_' || CAST(r.project_id AS VARCHAR) AS id, {uuid_sql("CAST(r.person_id AS VARCHAR) || '_' || CAST(r.project_id AS VARCHAR)")} AS atlas_id, r.person_id, pe.atlas_id AS atlas_person_id,
  r.project_id, pr.atlas_id AS atlas_project_id, {d_iso('ts', '%Y-%m-%dT00:00:00')} AS created_at, {d_iso('ts', '%Y-%m-%dT00:00:00')} AS updated_at, status, '1' AS owner_id, '{MASTER}' AS atlas_owner_id
FROM r JOIN {PEOPLE} pe ON pe.id = r.person_id JOIN {PROJECTS} pr ON pr.id = r.project_id WHERE rn = 1""")
def _(t: Tables):
    parts = [t.stages.where(f"{c} IS NOT NULL").select(F.col("candidate_id").alias("person_id"), "project_id", F.lit(s).alias("status"), F.col(c).alias("ts"))
             for s, c in (("Hired", "hire"), ("Internal IV", "interview1"), ("Added", "added"))]
    return candidates.build_candidates_from_stages(reshape.union_all(*parts), t.projects, t.people, CTX)


_NOTE_CTX = CTX.__class__(CTX.client, CTX.agency_id, CTX.master_id, CTX.domain, CTX.run_ts, {"notes": ["call", "note"], "meetings": ["interview"]})
_NOTE_TAIL = f"""SELECT id, {id_sql('id')} AS atlas_id, person_id, atlas_person_id, created_by_id, created_by_atlas_id, action"""


def _note_rows(where: str) -> str:
    return f"""WITH b AS (SELECT * FROM {COMMENTS} WHERE {where}),
r AS (SELECT b.* REPLACE (p.id AS person_id), p.atlas_id AS atlas_person_id, coalesce(u.atlas_id, '{MASTER}') AS created_by_atlas_id FROM b JOIN {PEOPLE} p ON p.id = b.person_id LEFT JOIN {USERS} u ON u.id = b.created_by_id
    WHERE b.person_id NOT IN (SELECT contact_id FROM {DUPES})
  UNION ALL SELECT b.* REPLACE (p.id AS person_id), p.atlas_id, coalesce(u.atlas_id, '{MASTER}') FROM b JOIN {DUPES} d ON d.contact_id = b.person_id JOIN {PEOPLE} p ON p.id = d.candidate_id LEFT JOIN {USERS} u ON u.id = b.created_by_id),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY person_id) AS rn FROM r) WHERE rn = 1) """


@query("e18_person_notes", _note_rows("comments IS NOT NULL AND comments != '' AND lower(trim(action)) NOT IN ('mail merge', 'email/linkedin message', 'email updated', 'out-bound email') AND lower(trim(action)) IN ('call', 'note')")
       + _NOTE_TAIL + f""", {d_tags('comments', ' ')} AS text, {d_iso('added_at')} AS created_at, {d_iso('added_at')} AS updated_at, 'manual' AS type FROM one""")
def _(t: Tables):
    return notes.build_person_notes(t.comments, t.people, t.users, _NOTE_CTX, dupes(t))


@query("e18_form_notes", f"""
SELECT 'form_' || CAST(form_id AS VARCHAR) AS id, {uuid_sql('form_id', 'person_id')} AS atlas_id, person_id, p.atlas_id AS atlas_person_id, '{MASTER}' AS created_by_id, '{MASTER}' AS created_by_atlas_id,
  title || chr(10) || chr(10) || answers AS text, 'manual' AS type, '{MIDNIGHT}' AS created_at, '{MIDNIGHT}' AS updated_at
FROM (SELECT conv_id AS form_id, conv_id AS person_id, 'Form' AS title, string_agg('- ' || q || ': ' || trim(text), chr(10) ORDER BY q) AS answers
  FROM (SELECT *, 'q' || lpad(CAST(turn AS VARCHAR), 4, '0') AS q FROM conversations WHERE text IS NOT NULL AND trim(text) <> '') GROUP BY conv_id) a JOIN {PEOPLE} p ON p.id = a.person_id""")
def _(t: Tables):
    answers = t.conversations.selectExpr("conv_id AS form_id", "conv_id AS person_id", "'Form' AS title", "'q' || lpad(CAST(turn AS STRING), 4, '0') AS question", "text AS answer")
    return notes.build_form_notes(answers, t.people, CTX)


_MAILS = "(SELECT page_id AS id, page_id % 30 AS created_by_id, 'a' || CAST(page_id AS STRING) || '@x.com' AS sender, url AS receiver, CASE WHEN page_id % 3 = 0 THEN NULL ELSE 'Re: ' || url END AS subject, html AS body, CAST('2024-03-04 05:06:07' AS TIMESTAMP) AS created_at FROM pages)"
_MAIL_LINKS = "(SELECT CAST(floor(event_id / 40) AS BIGINT) AS email_id, user_id AS person_id FROM events GROUP BY 1, 2)"


@query("e18_email_notes", f"""
SELECT e.id, {uuid_sql('e.id', 'l.person_id')} AS atlas_id, '2024-03-04T00:00:00' AS created_at, '2024-03-04T00:00:00' AS updated_at,
  'From: ' || coalesce(sender, '') || ' | To: ' || coalesce(receiver, '') || CASE WHEN subject IS NOT NULL AND subject <> '' THEN ' — ' || subject ELSE '' END || ' ' || clean AS text,
  l.person_id, p.atlas_id AS atlas_person_id, e.created_by_id, coalesce(u.atlas_id, '{MASTER}') AS created_by_atlas_id, 'manual' AS type
FROM (SELECT *, {d_clean_html('body')} AS clean FROM {_MAILS}) e JOIN {_MAIL_LINKS} l ON l.email_id = e.id JOIN {PEOPLE} p ON p.id = l.person_id LEFT JOIN {USERS} u ON u.id = e.created_by_id""")
def _(t: Tables):
    mails = t.pages.selectExpr("page_id AS id", "page_id % 30 AS created_by_id", "'a' || CAST(page_id AS STRING) || '@x.com' AS sender", "url AS receiver",
                               "CASE WHEN page_id % 3 = 0 THEN NULL ELSE 'Re: ' || url END AS subject", "html AS body", "TIMESTAMP '2024-03-04 05:06:07' AS created_at")
    links = t.events.selectExpr("floor(event_id / 40) AS email_id", "user_id AS person_id")
    return notes.build_email_notes(mails, links, t.people, t.users, CTX)


_NOTE_SRC = "(SELECT o_orderkey AS id, CAST(o_custkey % 30 AS INT) AS created_by_id, CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE o_orderpriority END AS text, CASE WHEN o_orderstatus = 'O' THEN 'Phone call' ELSE 'Memo' END AS kind, o_orderdate AS created_at FROM orders)"


@query("e18_linked_notes", f"""
WITH base AS (SELECT l_orderkey AS note_id, l_suppkey AS person_id FROM lineitem WHERE l_linenumber <= 3 UNION ALL SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_linenumber > 2),
d AS (SELECT DISTINCT note_id, person_id FROM base), n AS (SELECT *, row_number() OVER (PARTITION BY note_id ORDER BY person_id) AS rn FROM d)
SELECT CAST(n.note_id AS VARCHAR) || '_' || CAST(n.rn AS VARCHAR) AS id, {uuid_sql('n.note_id', 'n.person_id', f"'{CTX.client}'")} AS atlas_id, n.person_id, p.atlas_id AS atlas_person_id, {d_iso('t.created_at')} AS created_at,
  {d_iso('t.created_at')} AS updated_at, t.created_by_id, coalesce(u.atlas_id, '{MASTER}') AS created_by_atlas_id, CASE t.kind WHEN 'Phone call' THEN 'phone_call' ELSE 'manual' END AS type, t.text, n.note_id AS source_note_id
FROM n JOIN {_NOTE_SRC} t ON t.id = n.note_id JOIN {PEOPLE} p ON p.id = n.person_id LEFT JOIN {USERS} u ON u.id = t.created_by_id WHERE trim(t.text) <> ''""")
def _(t: Tables):
    pairs = t.lineitem.selectExpr("l_orderkey AS note_id", "l_suppkey AS person_id", "l_linenumber AS n")
    rows = t.orders.selectExpr("o_orderkey AS id", "CAST(o_custkey % 30 AS INT) AS created_by_id", "CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE o_orderpriority END AS text",
                               "CASE WHEN o_orderstatus = 'O' THEN 'Phone call' ELSE 'Memo' END AS kind", "o_orderdate AS created_at")
    return notes.build_linked_notes([pairs.where("n <= 3"), pairs.where("n > 2")], rows, t.people, t.users, CTX)


_SECTIONS = [("internal", "Internal notes", "html"), ("benefits", "Benefits package", "city"), ("terms", "Terms agreed", "address1")]


def _company_note(tag: str, label: str, column: str) -> str:
    return (f"SELECT '{tag}_' || CAST(s.id AS VARCHAR) AS id, {id_sql('s.id', chr(39) + '::' + chr(39), chr(39) + column + chr(39))} AS atlas_id, s.id AS company_id, c.atlas_id AS atlas_company_id, "
            f"'{label}:' || chr(13) || chr(10) || nullif(trim({d_clean_html('s.' + column)}), '') AS text, 'manual' AS type, {d_iso('s.added_at')} AS created_at, {d_iso('s.modified_at')} AS updated_at, "
            f"NULL AS created_by_id, '{MASTER}' AS created_by_atlas_id FROM {CONTACTS} s JOIN {COMPANIES} c ON c.id = s.id WHERE nullif(trim({d_clean_html('s.' + column)}), '') IS NOT NULL")


@query("e19_company_notes", " UNION ALL ".join(_company_note(*s) for s in _SECTIONS))
def _(t: Tables):
    return notes.build_section_notes(t.contacts.withColumn("company_id", F.col("id")), t.companies, CTX, _SECTIONS, "company")


@query("e20_meetings", _note_rows("lower(trim(action)) IN ('interview')") + _NOTE_TAIL
       + f""", {d_tags('comments', ' ')} AS notes, 'migrated meeting' AS name, {d_iso('added_at')} AS created_at, {d_iso('added_at')} AS updated_at, 'completed' AS status FROM one""")
def _(t: Tables):
    return notes.build_meetings(t.comments, t.people, t.users, _NOTE_CTX, dupes(t))


_CHANNEL = """(SELECT event_id AS id, CAST(event_id % 30 AS INT) AS created_by_id, CASE event_id % 3 WHEN 0 THEN 'Person' WHEN 1 THEN 'brief' ELSE 'other' END AS channel_type,
  CASE WHEN event_id % 3 = 0 THEN user_id ELSE CAST(floor(event_id / 50) AS BIGINT) END AS channel_id, '<i>' || event_type || '</i>' AS details, ts AS start_at, CASE WHEN event_id % 2 = 0 THEN ts END AS end_at, ts AS created_at, ts AS updated_at FROM events)"""
_BRIEFS = "(SELECT event_id AS id, CAST(floor(event_id / 48) AS BIGINT) AS project_id, user_id AS person_id, ts AS created_at FROM events WHERE event_type = 'signup')"


@query("e20_channel_meetings", f"""
WITH m AS (SELECT * FROM {_CHANNEL}),
a AS (SELECT m.*, b.person_id, row_number() OVER (PARTITION BY m.id ORDER BY abs(date_diff('second', date_trunc('second', m.start_at), date_trunc('second', b.created_at))), b.id DESC) AS rn
  FROM m JOIN {_BRIEFS} b ON b.project_id = m.channel_id WHERE lower(channel_type) IN ('assignment', 'brief', 'project')),
r AS (SELECT m.*, m.channel_id AS person_id FROM m WHERE lower(channel_type) IN ('person', 'people', 'candidate', 'contact') UNION ALL SELECT * EXCLUDE (rn) FROM a WHERE rn = 1)
SELECT r.id, {uuid_sql('r.id')} AS atlas_id, r.person_id, p.atlas_id AS atlas_person_id, r.created_by_id, coalesce(u.atlas_id, '{MASTER}') AS created_by_atlas_id, 'meeting' AS action, {d_tags("coalesce(details, '')", ' ')} AS notes,
  'migrated meeting' AS name, {d_iso('r.created_at')} AS created_at, {d_iso('coalesce(r.updated_at, r.end_at)')} AS updated_at,
  CASE WHEN r.end_at IS NOT NULL AND r.end_at < CAST('{NOW}' AS TIMESTAMP) THEN 'completed' ELSE 'planned' END AS status FROM r JOIN {PEOPLE} p ON p.id = r.person_id LEFT JOIN {USERS} u ON u.id = r.created_by_id""")
def _(t: Tables):
    raw = t.events.selectExpr(
        "event_id AS id", "CAST(event_id % 30 AS INT) AS created_by_id", "CASE event_id % 3 WHEN 0 THEN 'Person' WHEN 1 THEN 'brief' ELSE 'other' END AS channel_type",
        "CASE WHEN event_id % 3 = 0 THEN user_id ELSE CAST(floor(event_id / 50) AS BIGINT) END AS channel_id", "'<i>' || event_type || '</i>' AS details", "ts AS start_at",
        "CASE WHEN event_id % 2 = 0 THEN ts END AS end_at", "ts AS created_at", "ts AS updated_at")
    briefs = t.events.where("event_type = 'signup'").selectExpr("event_id AS id", "CAST(floor(event_id / 48) AS BIGINT) AS project_id", "user_id AS person_id", "ts AS created_at")
    return notes.build_channel_meetings(raw, briefs, t.people, t.users, CTX)


_PAY = f"(SELECT c.id AS person_id, c.salary_text AS current_salary, s.salary_text AS expected_pay, x.mixed AS created_on, x.us AS modified_on FROM {CONTACTS} c JOIN {CONTACTS} s ON s.id = (c.id + 3) % 150 JOIN {TEXTS} x ON x.id = c.id)"


def _pay_row(kind: str) -> str:
    label, tag = ("Salary::", "::salary::") if kind == "actual" else ("Salary_expected::", "::salary_expected::")
    low, high = d_number("expected_pay", 1), f"coalesce({d_number('expected_pay', 2)}, {d_number('expected_pay', 1)})"
    basic = "CASE WHEN regexp_matches(trim(current_salary), '^[0-9]+(\\.[0-9]+)?$') THEN CAST(round(TRY_CAST(current_salary AS DECIMAL(15,2))) AS BIGINT) END"
    where = ("nullif(trim(current_salary), '') IS NOT NULL AND trim(current_salary) <> '0.0'" if kind == "actual"
             else "nullif(trim(expected_pay), '') IS NOT NULL AND upper(trim(expected_pay)) <> 'NA'")
    amounts = f"{basic} AS basic_salary, NULL AS expected_salary_min, NULL AS expected_salary_max" if kind == "actual" else f"NULL, {low}, {high}"
    return (f"SELECT '{label}' || CAST(person_id AS VARCHAR) AS id, {id_sql(chr(39) + tag + chr(39), 'person_id')} AS atlas_id, person_id, p.atlas_id AS atlas_person_id, {d_iso(d_stamp('created_on'))} AS created_at, "
            f"{d_iso(d_stamp('modified_on'))} AS updated_at, {d_iso(d_stamp('modified_on'))} AS relevant_date, {amounts}, 'GBP' AS currency, 'gross' AS tax_method, 'total' AS expected_salary_type, "
            f"'migration' AS source, '{kind}' AS type, '{MASTER}' AS created_by_id, '{MASTER}' AS created_by_atlas_id, '{AGENCY}' AS agency_id FROM {_PAY} s JOIN {COMPANIES} p ON p.id = s.person_id WHERE {where}")


@query("e21_salaries_text", f"{_pay_row('actual')} UNION ALL {_pay_row('expected')}")
def _(t: Tables):
    other = t.contacts.selectExpr("id AS _o", "salary_text AS expected_pay")
    raw = (t.contacts.selectExpr("id AS person_id", "salary_text AS current_salary", "(id + 3) % 150 AS _o").join(other, "_o")
           .join(t.id_texts.selectExpr("id AS person_id", "mixed AS created_on", "us AS modified_on"), "person_id"))
    return salaries.build_salaries_from_text(raw, t.companies, CTX)


_BASE, _BONUS = "base", "bonus"


@query("e21_salaries_bonus", f"""
WITH s AS (SELECT o_orderkey AS id, o_custkey AS person_id, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(round(o_totalprice) AS BIGINT) END AS base, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN o_orderkey % 101 ELSE 500 + o_orderkey % 9000 END AS bonus,
    left(o_orderpriority, 3) AS cur, CASE WHEN o_orderkey % 3 = 0 THEN 'n' END AS notes, o_orderdate AS created_at FROM orders),
x AS (SELECT *, CASE WHEN base IS NOT NULL AND bonus BETWEEN 0 AND 100 THEN base * bonus / 100.0 ELSE bonus END AS b FROM s)
SELECT x.id, {uuid_sql('x.id', 'person_id')} AS atlas_id, {d_iso('created_at')} AS created_at, {d_iso('created_at')} AS updated_at, '{AGENCY}' AS agency_id, '{MASTER}' AS created_by_id, '{MASTER}' AS created_by_atlas_id, person_id, p.atlas_id AS atlas_person_id,
  base AS basic_salary, CAST(round(b) AS BIGINT) AS bonus_salary, CASE WHEN base IS NOT NULL OR bonus IS NOT NULL THEN CAST(round(coalesce(base, 0) + coalesce(b, 0)) AS BIGINT) END AS total_salary,
  CASE WHEN length(trim(cur)) = 3 THEN upper(trim(cur)) ELSE 'GBP' END AS currency, notes, 'gross' AS tax_method, 'total' AS expected_salary_type, 'migration' AS source, 'actual' AS type, {d_iso('created_at', '%Y-%m-%dT00:00:00')} AS relevant_date
FROM x JOIN {COMPANIES} p ON p.id = x.person_id WHERE base IS NOT NULL OR bonus IS NOT NULL OR notes IS NOT NULL""")
def _(t: Tables):
    raw = t.orders.selectExpr(
        "o_orderkey AS id", "o_custkey AS person_id", "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(round(o_totalprice) AS BIGINT) END AS base",
        "CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN o_orderkey % 101 ELSE 500 + o_orderkey % 9000 END AS bonus", "left(o_orderpriority, 3) AS currency",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'n' END AS notes", "o_orderdate AS created_at", "CAST(NULL AS TIMESTAMP_NTZ) AS updated_at")
    return salaries.build_salaries_with_bonus(raw, t.companies, CTX)


def _rate(column: str, method: str, tag: str) -> str:
    return (f"SELECT '{tag}_' || CAST(s.id AS VARCHAR) AS id, {uuid_sql('s.id', chr(39) + tag + chr(39))} AS atlas_id, s.id AS person_id, p.atlas_id AS atlas_person_id, CAST(round({column}) AS BIGINT) AS basic_salary, "
            f"'{method}' AS tax_method, {d_iso('added_at')} AS created_at, {d_iso('added_at')} AS updated_at, 'GBP' AS currency, 'total' AS expected_salary_type, '{MASTER}' AS created_by_id, '{MASTER}' AS created_by_atlas_id, 'actual' AS type, 'migration' AS source FROM {CONTACTS} s JOIN {COMPANIES} p ON p.id = s.id WHERE {column} > 0")


@query("e21_salary_rates", " UNION ALL ".join((_rate("headcount", "gross", "salary"), _rate("balance", "daily_rate", "day"), _rate("email_status", "hourly_rate", "hourly"))))
def _(t: Tables):
    raw = t.contacts.selectExpr("id AS person_id", "CAST(headcount AS BIGINT) AS salary", "balance AS day_rate", "CAST(email_status AS BIGINT) AS hourly_rate", "added_at")
    return salaries.build_salary_rates(raw, t.companies, CTX)


ATTRIBUTES = [("Kind", "company", True), ("Brand Name", "company", True), ("Words", "company", False)]
_ATTR = " UNION ALL ".join(f"SELECT '{n}' AS name, '{o}' AS \"of\", {str(m).upper()} AS multiple_values" for n, o, m in ATTRIBUTES)
_ATTR_REL = f"(SELECT lower(replace(name, ' ', '_')) AS alias, {uuid_sql('name')} AS atlas_id, name, \"of\", multiple_values FROM ({_ATTR}))"


_VALUES = """(SELECT DISTINCT 'kind' AS alias, trim(p_type) AS value FROM part UNION ALL SELECT DISTINCT 'brand_name', trim(p_brand) FROM part
  UNION ALL SELECT DISTINCT 'words', trim(w) FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) WHERE trim(w) <> '')"""
_OPTIONS = f"""(SELECT v.alias || '_' || v.value AS id, {uuid_sql('v.alias', 'v.value')} AS atlas_id, a.atlas_id AS atlas_attribute_id, v.value, CAST(row_number() OVER (PARTITION BY a.atlas_id ORDER BY v.value) AS INT) AS position
  FROM {_VALUES} v JOIN {_ATTR_REL} a ON a.alias = v.alias)"""


def _option_values(t: Tables):
    words = reshape.explode_list(t.attribute_rows.select("words"), "words", "value").select(F.lit("words").alias("alias"), "value")
    codes = reshape.tagged_values({"kind": (t.attribute_rows, F.col("kind")), "brand_name": (t.attribute_rows, F.col("brand"))})
    return reshape.union_distinct(codes, words)


def _options(t: Tables):
    return attributes.build_attribute_options(_option_values(t), attributes.build_custom_attributes(t.spark, ATTRIBUTES, CTX), CTX)


@query("e23_attribute_options", f"SELECT *, '{MIDNIGHT}' AS created_at, '{MIDNIGHT}' AS updated_at, '{AGENCY}' AS agency_id FROM {_OPTIONS}")
def _(t: Tables):
    return _options(t)


_HELD = """(SELECT p_partkey AS owner_id, 'kind' AS alias, upper(p_type) AS value FROM part UNION ALL SELECT p_partkey, 'brand_name', p_brand FROM part
  UNION ALL SELECT p_partkey, 'words', w FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part))"""


@query("e24_attribute_values", f"""
SELECT DISTINCT {uuid_sql('c.atlas_id', 'a.atlas_id', 'o.atlas_id')} AS atlas_id, h.owner_id AS company_id, c.atlas_id AS atlas_company_id, a.atlas_id AS atlas_custom_attribute_id, o.atlas_id AS atlas_option_id,
  '{MIDNIGHT}' AS created_at, '{MIDNIGHT}' AS updated_at FROM {_HELD} h JOIN {_ATTR_REL} a ON a.alias = h.alias JOIN {_OPTIONS} o ON o.atlas_attribute_id = a.atlas_id AND lower(o.value) = lower(h.value)
JOIN {COMPANIES} c ON c.id = h.owner_id WHERE h.value <> ''""")
def _(t: Tables):
    wide = reshape.unpivot(t.attribute_rows, ["id"], [{"alias": F.lit("kind"), "value": F.upper("kind")}, {"alias": F.lit("brand_name"), "value": F.col("brand")}])
    words = reshape.explode_list(t.attribute_rows.select("id", "words"), "words", "value").select("id", F.lit("words").alias("alias"), "value")
    held = reshape.union_all(wide, words).withColumnRenamed("id", "owner_id")
    return attributes.build_attribute_values(held, _options(t), attributes.build_custom_attributes(t.spark, ATTRIBUTES, CTX), t.companies, CTX, "company", ignore_case=True)


_FEE_TYPE = uuid_sql(f"'{AGENCY}'", "'fee_type_projected'")


_PLACED = f"(SELECT id, person_id, project_id, CASE WHEN flag = 'N' THEN 0 ELSE CAST(project_id % 9 * 1000 AS BIGINT) END AS salary, CAST('0.' || CAST(10 + line AS STRING) AS DECIMAL(18,6)) AS rate, CASE WHEN flag = 'R' THEN ' paid ' END AS comments, added_at FROM {APPS})"


def _placed(t: Tables):
    return t.applications.selectExpr("id", "person_id", "project_id", "CASE WHEN flag = 'N' THEN 0 ELSE CAST(project_id % 9 * 1000 AS BIGINT) END AS salary", "CAST('0.' || CAST(10 + line AS STRING) AS DECIMAL(18,6)) AS rate",
                                                          "CASE WHEN flag = 'R' THEN ' paid ' END AS comments", "added_at")


_FEES = f"""(SELECT CAST(rate AS VARCHAR) || '_paid_' || CAST(f.id AS VARCHAR) AS id, {uuid_sql("CAST(rate AS VARCHAR) || '_paid_' || CAST(f.id AS VARCHAR)")} AS atlas_id, f.project_id, j.atlas_id AS atlas_project_id, f.person_id AS candidate_id,
  p.atlas_id AS person_id, {d_iso('added_at')} AS created_at, {d_iso('added_at')} AS updated_at, '{MASTER}' AS created_by_id, '{MASTER}' AS created_by_atlas_id, '{AGENCY}' AS agency_id, {_FEE_TYPE} AS fee_type_id, {d_iso('added_at', '%Y-%m-%d')} AS fee_date,
  CAST(round(CAST(salary AS DECIMAL(18,2)) * rate) AS BIGINT) AS amount, 'GBP' AS currency, 'paid' AS project_fee_status, CASE WHEN trim(coalesce(comments, '')) != '' THEN trim(comments) ELSE 'Migrated Placement Fee' END AS notes,
  'placement' AS category, salary AS payment_amount, 'GBP' AS payment_currency FROM {_PLACED} f JOIN {PEOPLE} p ON p.id = f.person_id JOIN {PROJECTS} j ON j.id = f.project_id WHERE salary <> 0)"""


@query("e26_project_fees", f"SELECT * FROM {_FEES}")
def _(t: Tables):
    return fees.build_project_fees(_placed(t), t.people, t.projects, fees.build_fee_types(t.spark, CTX), CTX)


_COMMISSION = "(SELECT l_orderkey * 10000000 + l_partkey * 100 + l_linenumber AS id, l_orderkey AS project_id, ' USER' || CAST(l_suppkey % 30 AS VARCHAR) || '@corp.example.com' AS email, CAST(l_discount AS DECIMAL(18,6)) AS rate FROM lineitem)"


@query("e27_fee_splits", f"""
SELECT c.id, {id_sql('c.id')} AS atlas_id, c.project_id, p.atlas_id AS atlas_project_id, u.id AS fee_earner_id, u.atlas_id AS atlas_fee_earner_id, '{MASTER}' AS atlas_created_by_id, {_FEE_TYPE} AS atlas_fee_type_id, CAST(CAST(rate * 100 AS DECIMAL(18,2)) AS VARCHAR) AS share,
  '{AGENCY}' AS agency_id FROM {_COMMISSION} c JOIN {USERS} u ON lower(trim(u.email)) = lower(trim(c.email)) JOIN {PROJECTS} p ON p.id = c.project_id""")
def _(t: Tables):
    raw = t.lineitem.selectExpr("l_orderkey * 10000000 + l_partkey * 100 + l_linenumber AS id", "l_orderkey AS project_id", "' USER' || CAST(l_suppkey % 30 AS STRING) || '@corp.example.com' AS email",
                                "CAST(l_discount AS DECIMAL(18,6)) AS rate")
    return fees.build_fee_splits(raw, t.projects, t.users, fees.build_fee_types(t.spark, CTX), CTX).withColumn("share", F.col("share").cast("string"))


@query("e28_placements", f"""
SELECT 'placement_' || f.id AS id, {uuid_sql('f.atlas_id', 'c.atlas_id', client='placement')} AS atlas_id, f.created_at, f.project_id, f.atlas_project_id, c.id AS candidate_id, c.atlas_id AS atlas_candidate_id, f.id AS project_fee_id, f.atlas_id AS atlas_project_fee_id FROM {_FEES} f
JOIN (SELECT *, {id_sql('id')} AS atlas_id FROM (SELECT *, row_number() OVER (PARTITION BY project_id, person_id ORDER BY added_at DESC, id DESC) AS rn FROM {APPS}
      WHERE project_id IN (SELECT id FROM {PROJECTS}) AND person_id IN (SELECT id FROM {PEOPLE})) WHERE rn = 1) c ON c.project_id = f.project_id AND c.person_id = f.candidate_id""")
def _(t: Tables):
    paid = fees.build_project_fees(_placed(t), t.people, t.projects, fees.build_fee_types(t.spark, CTX), CTX)
    held = candidates.build_candidates(t.applications, t.projects, t.people, t.users, CTX, marks())
    return candidates.build_placements(paid, held)


@query("e29_file_mapping", f"""
SELECT owner_id AS person_id, p.atlas_id AS atlas_person_id, f.name AS actual_file_name, CASE WHEN f.name ILIKE '%resume%' OR f.name ILIKE '%cv%' THEN 'resume' ELSE 'other' END AS type,
  replace('people/' || 'a\\b\\' || CAST(f.id AS VARCHAR) || ext, '\\', '/') AS file_name, {d_iso('added_at')} AS created_at
FROM (SELECT event_id AS id, user_id AS owner_id, CASE event_id % 3 WHEN 0 THEN 'My CV' WHEN 1 THEN 'Resume 2' ELSE 'photo' END || '.x' AS name, CASE event_id % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.DOCX' WHEN 2 THEN '.png' ELSE '.txt' END AS ext, ts AS added_at FROM events) f
JOIN {PEOPLE} p ON p.id = f.owner_id WHERE lower(ext) IN ('.pdf', '.docx', '.doc', '.txt')""")
def _(t: Tables):
    raw = t.events.selectExpr("event_id AS id", "user_id AS owner_id", "'a\\\\b\\\\' AS folder", "CASE event_id % 3 WHEN 0 THEN 'My CV' WHEN 1 THEN 'Resume 2' ELSE 'photo' END || '.x' AS name",
                              "CASE event_id % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.DOCX' WHEN 2 THEN '.png' ELSE '.txt' END AS extension", "ts AS added_at")
    return files.build_file_mapping(raw, t.people)


@query("e29_stored_files", "SELECT page_id AS id, url AS path, regexp_replace(url, '^.*/', '') AS file_name, regexp_replace(url, '^.*\\.([^.]+)$', '\\1') AS ext FROM pages")
def _(t: Tables):
    return files.stored_files(t.pages.selectExpr("page_id AS id", "url AS path"))


def _merged_sql(links: str) -> str:
    return f"""
SELECT s.contact_id AS original_person_id, s.candidate_id AS merge_person_id, a.atlas_id AS atlas_original_person_id, b.atlas_id AS atlas_merge_person_id,
  coalesce(e.candidate_id, s.contact_id) AS surviving_person_id, c.atlas_id AS atlas_surviving_person_id, s.linkedin AS linkedin_url, s.email
FROM {links} s LEFT JOIN {d_survivors(links, 'contact_id', 'candidate_id')} e ON e.contact_id = s.contact_id
LEFT JOIN {COMPANIES} a ON a.id = s.contact_id LEFT JOIN {COMPANIES} b ON b.id = s.candidate_id LEFT JOIN {COMPANIES} c ON c.id = coalesce(e.candidate_id, s.contact_id)
WHERE s.contact_id IS NOT NULL"""


@query("e31_merged_people", _merged_sql(f"(SELECT linked_id AS contact_id, id AS candidate_id, linkedin, email FROM {CONTACTS} WHERE linked_id IS NOT NULL)"))
def _(t: Tables):
    return corrections.merged_people(t.contacts.withColumnRenamed("linked_id", "previous_id"), t.companies)


@query("e31_merge_chains", _merged_sql(f"(SELECT contact_id, candidate_id, email, email AS linkedin FROM {_MERGES} WHERE candidate_id IS NOT NULL)"))
def _(t: Tables):
    raw = _merges(t).where("candidate_id IS NOT NULL").selectExpr("contact_id AS previous_id", "candidate_id AS id", "email", "email AS linkedin")
    return corrections.merged_people(raw, t.companies)


_PARSED = f"(SELECT CASE WHEN id % 5 = 0 THEN -id ELSE id END AS person_id, zip AS postcode, address1 AS line1, address2 AS line2, state, country FROM {CONTACTS})"
_ENTERED = f"(SELECT CASE WHEN id % 3 = 0 THEN id ELSE -id END AS person_id, CASE WHEN id % 2 = 0 THEN zip END AS postcode, city AS line1, NULL AS line2, city AS state, NULL AS country FROM {CONTACTS})"


@query("e31_corrected_locations", f"""
SELECT p.id AS person_id, p.atlas_id AS atlas_person_id, coalesce(e.postcode, r.postcode) AS location_postal_code, coalesce(e.line1, r.line1) AS location_street_address, coalesce(e.line2, r.line2) AS location_address_line_2,
  coalesce(e.state, r.state) AS location_metro, coalesce(e.country, r.country) AS location_country,
  regexp_replace(regexp_replace(coalesce(e.line1, r.line1, '') || ',' || coalesce(e.line2, r.line2, '') || ',' || coalesce(e.state, r.state, '') || ',' || coalesce(e.postcode, r.postcode, '') || ',' || coalesce(e.country, r.country, ''),
    '(^,*)|(,*$)', '', 'g'), ',+', ', ', 'g') AS location_locality
FROM {COMPANIES} p LEFT JOIN {_PARSED} r ON r.person_id = p.id LEFT JOIN {_ENTERED} e ON e.person_id = p.id""")
def _(t: Tables):
    parsed = t.contacts.selectExpr("CASE WHEN id % 5 = 0 THEN -id ELSE id END AS person_id", "zip AS postcode", "address1 AS line1", "address2 AS line2", "state", "country")
    entered = t.contacts.selectExpr("CASE WHEN id % 3 = 0 THEN id ELSE -id END AS person_id", "CASE WHEN id % 2 = 0 THEN zip END AS postcode", "city AS line1", "CAST(NULL AS STRING) AS line2", "city AS state", "CAST(NULL AS STRING) AS country")
    return corrections.corrected_locations(t.companies, parsed, entered)


@query("e31_repaired_notes", f"""
SELECT CAST(n.id AS VARCHAR) AS id, CAST(n.id AS VARCHAR) AS atlas_id, n.person_id, p.atlas_id AS atlas_person_id, {d_iso('added_at', '%Y-%m-%dT%H:%M:%SZ')} AS created_at, {d_iso('added_at', '%Y-%m-%dT%H:%M:%SZ')} AS updated_at, created_by_id,
  coalesce(u.atlas_id, '{MASTER}') AS created_by_atlas_id, 'manual' AS type, n.txt AS text FROM (SELECT *, replace({d_tags('comments')}, '&nbsp;', ' ') AS txt FROM {COMMENTS}) n
LEFT JOIN {PEOPLE} p ON p.id = n.person_id LEFT JOIN {USERS} u ON u.id = n.created_by_id WHERE trim(n.txt) <> ''""")
def _(t: Tables):
    raw = t.comments.selectExpr("id", "person_id", "created_by_id", "comments AS text", "added_at AS created_at")
    return corrections.repaired_notes(raw, t.people, t.users, CTX)


_STAGE_NAMES = opportunities.DEFAULT_STAGES
_STAGE_REL = "(" + " UNION ALL ".join(f"SELECT '{n}' AS name, {i} AS position" for i, n in enumerate(_STAGE_NAMES, 1)) + ")"


_OPPS = f"""(SELECT o.id, {uuid_sql("'opportunity_'", 'o.id')} AS atlas_id, {d_iso('o.added_at')} AS created_at, {d_iso('o.added_at')} AS updated_at, o.name, 'regular' AS type, '{MASTER}' AS atlas_created_by_id,
  CAST(s.position AS VARCHAR) AS stage_id, o.owner_id, coalesce(u.atlas_id, '{MASTER}') AS atlas_owner_id, TRUE AS manual_named
  FROM (SELECT o_orderkey AS id, 'Opp ' || CAST(o_orderkey AS VARCHAR) AS name, o_custkey % 25 AS owner_id, CASE o_orderkey % 3 WHEN 0 THEN 'initial_request' WHEN 1 THEN 'late_stage' ELSE 'lost' END AS stage,
          o_orderstatus <> 'F' AS is_open, o_orderdate AS added_at, o_custkey AS company_id FROM orders) o
  LEFT JOIN {USERS} u ON u.id = o.owner_id JOIN {_STAGE_REL} s ON s.name = o.stage WHERE o.is_open)"""


def _opps(t: Tables):
    raw = t.orders.selectExpr("o_orderkey AS id", "'Opp ' || CAST(o_orderkey AS STRING) AS name", "o_custkey % 25 AS owner_id",
                              "CASE o_orderkey % 3 WHEN 0 THEN 'initial_request' WHEN 1 THEN 'late_stage' ELSE 'lost' END AS stage", "o_orderstatus <> 'F' AS is_open", "o_orderdate AS added_at")
    return opportunities.build_opportunities(raw, t.users, opportunities.build_opportunity_stages(t.spark, CTX), CTX)


@query("e33_opportunities", f"SELECT * FROM {_OPPS}")
def _(t: Tables):
    return _opps(t)


def _members(entity: str, raw: str, ref: str) -> str:
    key = "CAST(m.opportunity_id AS VARCHAR) || '_' || CAST(m.member_id AS VARCHAR)"
    return f"""SELECT {key} AS id, {uuid_sql(f"'{entity}_'", key)} AS atlas_id, {d_iso('m.added_at')} AS created_at, {d_iso('m.added_at')} AS updated_at, m.member_id AS {entity}_id, r.atlas_id AS atlas_{entity}_id,
  m.opportunity_id, o.atlas_id AS atlas_opportunity_id, '{MASTER}' AS created_by_id, '{MASTER}' AS atlas_created_by_id FROM {raw} m JOIN {_OPPS} o ON o.id = m.opportunity_id JOIN {ref} r ON r.id = m.member_id"""


@query("e33_opportunity_people", _members("person", "(SELECT l_orderkey AS opportunity_id, l_suppkey AS member_id, max(l_shipdate) AS added_at FROM lineitem GROUP BY 1, 2)", PEOPLE))
def _(t: Tables):
    raw = t.lineitem.groupBy(F.col("l_orderkey").alias("opportunity_id"), F.col("l_suppkey").alias("member_id")).agg(F.max("l_shipdate").alias("added_at"))
    return opportunities.build_opportunity_members(raw, _opps(t), t.people, CTX, "person")


@query("e33_target_companies", _members("company", "(SELECT o_orderkey AS opportunity_id, o_custkey AS member_id, o_orderdate AS added_at FROM orders)", COMPANIES))
def _(t: Tables):
    raw = t.orders.selectExpr("o_orderkey AS opportunity_id", "o_custkey AS member_id", "o_orderdate AS added_at")
    return opportunities.build_opportunity_members(raw, _opps(t), t.companies, CTX, "company")
