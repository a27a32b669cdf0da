"""Scans, predicates, joins, aggregates, windows and set operations against the SQL shapes they replace."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterlift.functions import codes, contact, dates, predicates
from rosterlift.functions.location import clean_placeholder
from rosterlift.operators import dedupe, history, joins, numbering, reshape
from rosterlift.plans.companies import current_position
from rosterlift.quality.suite import repeated_values
from rosterlift.session import scratch_folder
from rosterlift.sources import TableReader, constant_row, literal_relation, overwrite_table, read_range, read_shards, union_shards

from .base import CTX, NOW, Tables, query, src
from .column_queries import d_email, d_iso, d_linkedin, d_phone, d_placeholder

CONTACTS, PEOPLE, COMPANIES, PROJECTS, USERS = (src(n) for n in ("contacts", "people", "companies", "projects", "users"))
APPS, POSTINGS, COMMENTS, HISTORY = (src(n) for n in ("applications", "postings", "comments", "history"))
A_SIDE, B_SIDE = src("candidate_people"), src("contact_people")
MASTER = CTX.master_id


# -- sources ---------------------------------------------------------------------------------------------------

@query("s01_scan", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'")
def _(t: Tables):
    return t.lineitem.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("s02_upstream_reads", f"SELECT p.id, p.atlas_id, c.atlas_id AS atlas_company_id FROM {PROJECTS} p JOIN {COMPANIES} c ON c.id = p.company_id")
def _(t: Tables):
    return joins.fk_map(t.projects, "company_id", t.companies, "atlas_id", "atlas_company_id", policy="exclude").select(
        "id", "atlas_id", "atlas_company_id")


@query("s04_shards", """
SELECT l_orderkey AS id, CAST(l_linenumber AS DOUBLE) AS line, CASE WHEN l_orderkey % 60 = 7 THEN 'P' ELSE '' END || CAST(l_partkey AS VARCHAR) AS part,
  'work=' || CAST(l_orderkey % 60 AS VARCHAR) AS source_table FROM lineitem""")
def _(t: Tables):
    """Sixty shards written to folders and found by listing; part is text in one of them, line a fraction in another."""
    rows = t.lineitem.selectExpr("l_orderkey AS id", "l_linenumber AS line", "l_partkey AS part", "CAST(l_orderkey % 60 AS INT) AS work")
    folder = scratch_folder(t.spark)
    rows.where("work NOT IN (7, 11)").repartition("work").write.partitionBy("work").parquet(folder)
    rows.where("work = 7").selectExpr("id", "line", "concat('P', part) AS part").write.parquet(f"{folder}/work=7")
    rows.where("work = 11").selectExpr("id", "CAST(line AS DOUBLE) AS line", "part").write.parquet(f"{folder}/work=11")
    return read_shards(TableReader(t.spark, folder, suffix=""), "work={}", "work", "id long, line double, part string")


@query("s08_refresh", "SELECT o_orderkey, o_custkey + 1 AS o_custkey FROM orders WHERE o_orderkey % 3 <> 0")
def _(t: Tables):
    """A table that is replaced by what its own rows give."""
    folder = scratch_folder(t.spark)
    overwrite_table(t.orders.select("o_orderkey", "o_custkey"), f"{folder}/orders")
    read = TableReader(t.spark, folder, suffix="")
    overwrite_table(read("orders").where("o_orderkey % 3 <> 0").withColumn("o_custkey", F.col("o_custkey") + 1), f"{folder}/orders")
    return TableReader(t.spark, folder, suffix="")("orders")


@query("o01_clustered_range", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey BETWEEN 1000 AND 1200")
def _(t: Tables):
    """A range of a clustered copy, from the files whose footers say that they hold it."""
    path = f"{scratch_folder(t.spark)}/lineitem"
    overwrite_table(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), path, ["l_orderkey"], files=16)
    return read_range(t.spark, path, "l_orderkey", 1000, 1200)


@query("s05_shards_filtered", """
SELECT o_orderkey AS id, 'open' AS source_table FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, 'done' FROM orders WHERE o_orderstatus = 'F'""")
def _(t: Tables):
    rows = t.orders.selectExpr("o_orderkey AS id", "o_orderstatus")
    shards = {"open": rows.where("o_orderstatus = 'O'").select("id"), "done": rows.where("o_orderstatus = 'F'").select("id")}
    return union_shards(shards, {"open": F.col("id") % 2 == 0})


_FLAGS = (("R", "by_us"), ("A", "by_client"), ("N", "none"))


@query("s06_literal_relation", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, m.outcome FROM lineitem l
JOIN (SELECT 'R' AS flag, 'by_us' AS outcome UNION ALL SELECT 'A', 'by_client' UNION ALL SELECT 'N', 'none') m ON m.flag = l.l_returnflag""")
def _(t: Tables):
    flags = literal_relation(t.spark, ("flag", "outcome"), _FLAGS)
    return t.lineitem.join(F.broadcast(flags), F.col("l_returnflag") == F.col("flag")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "outcome")


@query("s07_constant_row", f"SELECT c.c_custkey, k.agency_id, k.created_at FROM customer c CROSS JOIN (SELECT '{CTX.agency_id}' AS agency_id, '{NOW}' AS created_at) k")
def _(t: Tables):
    return joins.with_constant(t.customer.select("c_custkey"), constant_row(t.spark, agency_id=CTX.agency_id, created_at=NOW))


@query("s09_row_count", "SELECT 'lineitem' AS name, count(*) AS n FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders")
def _(t: Tables):
    return reshape.union_all(*[getattr(t, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n")
                               for n in ("lineitem", "orders")])


# -- predicates ------------------------------------------------------------------------------------------------

@query("p01_rename_cast", "SELECT o_orderkey AS id, CAST(round(o_totalprice) AS BIGINT) AS salary, CAST(o_orderdate AS VARCHAR)[1:10] AS opened, TRY_CAST(o_orderpriority AS INT) AS priority FROM orders")
def _(t: Tables):
    price = F.round("o_totalprice").cast("bigint")
    return t.orders.select(F.col("o_orderkey").alias("id"), price.alias("salary"), dates.iso("o_orderdate", "date").alias("opened"),
                           F.col("o_orderpriority").try_cast("int").alias("priority"))


@query("p02_constants", f"SELECT c_custkey AS id, 'migration' AS source, 'active' AS responsiveness, '{CTX.agency_id}' AS agency_id, '{MASTER}' AS created_by FROM customer")
def _(t: Tables):
    return t.customer.select(F.col("c_custkey").alias("id"), F.lit("migration").alias("source"), F.lit("active").alias("responsiveness"),
                             CTX.agency().alias("agency_id"), CTX.master().alias("created_by"))


@query("p03_code_groups", f"""
SELECT id, CASE WHEN lower(trim(status)) IN ('active', 'terms signed') THEN 'client' WHEN lower(trim(status)) IN ('prospect') THEN 'target' ELSE 'none' END AS rel
FROM {CONTACTS}""")
def _(t: Tables):
    return t.contacts.select("id", codes.code_groups("status", {"client": ["active", "terms signed"], "target": ["prospect"]}, "none").alias("rel"))


@query("p04_simple_case", "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'P' THEN 'on_hold' WHEN 'F' THEN 'closed' ELSE 'lead' END AS state FROM orders")
def _(t: Tables):
    return t.orders.select("o_orderkey", codes.code_map("o_orderstatus", {"O": "active", "P": "on_hold", "F": "closed"}, "lead").alias("state"))


@query("p05_pattern_map", """
SELECT o_orderkey, CASE WHEN o_orderpriority ILIKE '%urgent%' THEN 'contract' WHEN o_orderpriority ILIKE '%high%' THEN 'full_time'
  WHEN o_orderpriority ILIKE '%not %' THEN 'part_time' ELSE 'other' END AS kind FROM orders""")
def _(t: Tables):
    kinds = [("%urgent%", "contract"), ("%high%", "full_time"), ("%not %", "part_time")]
    return t.orders.select("o_orderkey", codes.first_pattern("o_orderpriority", kinds, "other").alias("kind"))


_STAGES = src("stages")


@query("p06_stage_flags", f"""
SELECT id, CASE WHEN hire IS NOT NULL THEN 'Hired' WHEN offer IS NOT NULL THEN 'Offer' WHEN interview2 IS NOT NULL OR interview1 IS NOT NULL THEN 'Client IV'
  WHEN sent IS NOT NULL THEN 'Presented' ELSE 'Added' END AS status FROM {_STAGES}""")
def _(t: Tables):
    ladder = [("Hired", ["hire"]), ("Offer", ["offer"]), ("Client IV", ["interview2", "interview1"]), ("Presented", ["sent"])]
    return t.stages.select("id", codes.stage_from_dates(ladder, "Added").alias("status"))


@query("p07_lateral_alias", f"""
SELECT id, flag, CASE WHEN flag IS NOT NULL THEN 'other' END AS reason FROM (SELECT id, CASE WHEN flag = 'R' THEN 'by_us' WHEN flag = 'A' THEN 'by_client' END AS flag FROM {APPS})""")
def _(t: Tables):
    kind = codes.code_map("flag", {"R": "by_us", "A": "by_client"})
    return t.applications.select("id", kind.alias("flag")).withColumn("reason", F.when(F.col("flag").isNotNull(), "other"))


@query("p08_not_blank", f"SELECT id, city FROM {CONTACTS} WHERE city IS NOT NULL AND trim(city) <> ''")
def _(t: Tables):
    return t.contacts.where(predicates.not_blank("city")).select("id", "city")


@query("p09_soft_delete", f"""
SELECT id, 'not_one' AS style FROM {CONTACTS} WHERE is_deleted != 1 UNION ALL SELECT id, 'zero' FROM {CONTACTS} WHERE is_deleted = 0
UNION ALL SELECT id, 'false' FROM {CONTACTS} WHERE has_company = FALSE UNION ALL SELECT id, 'no_date' FROM {CONTACTS} WHERE state IS NULL""")
def _(t: Tables):
    flags = {"not_one": "is_deleted", "zero": "is_deleted", "false": "has_company", "no_date": "state"}
    marks = F.array(*[F.struct(F.lit(s).alias("style"), predicates.is_live(c, s).alias("live")) for s, c in flags.items()])
    return t.contacts.select("id", F.inline(marks)).where("live").select("id", "style")


@query("p10_placeholder_rows", f"SELECT id, name FROM {CONTACTS} WHERE lower(name) != 'prince'")
def _(t: Tables):
    return t.contacts.where(predicates.is_real_name("name", "Prince")).select("id", "name")


@query("p11_config_filter", f"SELECT id, action, 'set' AS mode FROM {COMMENTS} WHERE lower(trim(action)) IN ('call', 'interview') UNION ALL SELECT id, action, 'unset' FROM {COMMENTS}")
def _(t: Tables):
    rows = t.comments.select("id", "action")
    return reshape.union_all(rows.where(predicates.in_filter("action", ["Call", "Interview"])).withColumn("mode", F.lit("set")),
                             rows.where(predicates.in_filter("action", None)).withColumn("mode", F.lit("unset")))


@query("p12_regex", f"""
SELECT id, regexp_matches(city, '[a-z]{{2}}') AS cased, regexp_matches(city, '^l', 'i') AS folded, NOT regexp_matches(phone, '[a-z]', 'i') AS negated FROM {CONTACTS}""")
def _(t: Tables):
    return t.contacts.select("id", F.col("city").rlike("[a-z]{2}").alias("cased"), F.col("city").rlike("(?i)^l").alias("folded"),
                             (~F.col("phone").rlike("(?i)[a-z]")).alias("negated"))


@query("p13_like", f"SELECT id, email LIKE '%@%' AS a, email NOT LIKE '%corp%' AS b, email ILIKE '%GMAIL%' AS c, email NOT ILIKE '%yahoo%' AS d FROM {CONTACTS}")
def _(t: Tables):
    e = F.col("email")
    return t.contacts.select("id", e.like("%@%").alias("a"), (~e.like("%corp%")).alias("b"), e.ilike("%GMAIL%").alias("c"), (~e.ilike("%yahoo%")).alias("d"))


@query("p14_similar_to", f"SELECT id, regexp_full_match(website, 'http(s)?://.*') AS hit FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.select("id", predicates.similar_to("website", "http(s)?://%").alias("hit"))


@query("p15_between", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_quantity BETWEEN 5 AND 10")
def _(t: Tables):
    return t.lineitem.where(F.col("l_quantity").between(5, 10)).select("l_orderkey", "l_linenumber", "l_partkey")


@query("p16_auto_close", f"""
SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) < CAST('{CTX.today}' AS DATE) - INTERVAL 6 MONTH THEN 'closed' ELSE 'active' END AS late,
  CASE WHEN CAST(o_orderdate AS DATE) < CAST('1998-10-31' AS DATE) - INTERVAL 6 MONTH THEN 'closed' ELSE 'active' END AS state FROM orders""")
def _(t: Tables):
    def state(today: str):
        return F.when(dates.older_than_months("o_orderdate", today), "closed").otherwise("active")
    return t.orders.select("o_orderkey", state(CTX.today).alias("late"), state("1998-10-31").alias("state"))


@query("p17_row_values", "SELECT event_id FROM events WHERE (user_id, event_id) < (75, 5000)")
def _(t: Tables):
    return t.events.where(F.struct("user_id", "event_id") < F.struct(F.lit(75).cast("bigint"), F.lit(5000).cast("bigint"))).select("event_id")


@query("p18_placeholder_values", f"""
SELECT id, {d_placeholder('address1')} AS a, {d_placeholder('zip')} AS z, {d_placeholder('country', False)} AS c, {d_placeholder('linkedin')} AS l FROM {CONTACTS}""")
def _(t: Tables):
    return t.contacts.select("id", clean_placeholder("address1").alias("a"), clean_placeholder("zip").alias("z"),
                             clean_placeholder("country", digits_ok=False).alias("c"), clean_placeholder("linkedin").alias("l"))


_NOISE = ("web", "forum")


@query("p19_text_threshold", f"""
SELECT id, subject FROM {COMMENTS} WHERE subject NOT IN ('web', 'forum') AND ((body IS NOT NULL AND length(body) > 3000) OR (subject IS NOT NULL AND length(subject) > 4))""")
def _(t: Tables):
    return t.comments.where(predicates.is_note_worth_keeping("subject", "body", _NOISE, 3000, 4)).select("id", "subject")


@query("p20_file_types", """
SELECT page_id FROM (SELECT page_id, split_part(url, '?', 1) || CASE page_id % 4 WHEN 0 THEN '.PDF' WHEN 1 THEN '.docx' WHEN 2 THEN '.png' ELSE '' END AS name FROM pages)
WHERE lower(name) LIKE '%.pdf' OR lower(name) LIKE '%.docx' OR lower(name) LIKE '%.doc'""")
def _(t: Tables):
    name = F.concat(F.split_part("url", F.lit("?"), F.lit(1)),
                    codes.code_map(F.col("page_id") % 4, {0: ".PDF", 1: ".docx", 2: ".png"}, "")).alias("name")
    return t.pages.select("page_id", name).where(predicates.has_file_type("name", ("pdf", "docx", "doc"))).select("page_id")


_GENERIC = f"(SELECT id, CASE id % 4 WHEN 0 THEN email WHEN 1 THEN phone WHEN 2 THEN linkedin ELSE website END AS v FROM {CONTACTS})"


@query("p21_value_routing", f"""
SELECT id, CASE WHEN lower(v) LIKE '%linkedin.com%' THEN 'linkedin' WHEN v LIKE '%@%' THEN 'email'
  WHEN lower(trim(v)) LIKE 'http://%' OR lower(trim(v)) LIKE 'https://%' OR lower(trim(v)) LIKE 'www.%' THEN 'website'
  WHEN length(regexp_replace(v, '[^0-9]', '', 'g')) > 3 THEN 'phone' END AS kind FROM {_GENERIC}""")
def _(t: Tables):
    value = F.expr("CASE id % 4 WHEN 0 THEN email WHEN 1 THEN phone WHEN 2 THEN linkedin ELSE website END")
    return t.contacts.select("id", contact.identity_shape(value).alias("kind"))


@query("p22_domain", f"SELECT id, split_part(email, '@', 2) AS domain FROM {CONTACTS} WHERE lower(email) LIKE '%corp%'")
def _(t: Tables):
    return t.contacts.where(contact.in_domain("email", "corp")).select("id", contact.email_domain("email").alias("domain"))


@query("p23_person_rows", f"""
SELECT id FROM {CONTACTS} WHERE NOT (coalesce(name, '') LIKE '%@%') AND (lower(trim(coalesce(name, ''))) <> lower(trim(coalesce(email, ''))) OR trim(coalesce(name, '')) = '')""")
def _(t: Tables):
    return t.contacts.where(predicates.is_person_row("name", "email")).select("id")


@query("p24_noise_notes", f"""
SELECT id FROM {COMMENTS} WHERE NOT (coalesce(subject, '') ILIKE '%forum%' OR coalesce(comments, '') ILIKE '%copyright%') AND length(comments) > 100""")
def _(t: Tables):
    noisy = predicates.is_noise("subject", ["%forum%"]) | predicates.is_noise("comments", ["%copyright%"])
    return t.comments.where(~noisy & (F.length("comments") > 100)).select("id")


# -- joins -----------------------------------------------------------------------------------------------------

@query("j01_drop_orphans", f"SELECT a.id FROM {APPS} a JOIN {PROJECTS} p ON p.id = a.project_id JOIN {PEOPLE} q ON q.id = a.person_id")
def _(t: Tables):
    rows = joins.drop_orphans(t.applications, "project_id", t.projects)
    return joins.drop_orphans(rows, "person_id", t.people).select("id")


@query("j02_fk_fallback", f"SELECT a.id, coalesce(u.atlas_id, '{MASTER}') AS atlas_owner_id FROM {APPS} a LEFT JOIN {USERS} u ON u.id = a.owner_id")
def _(t: Tables):
    return joins.fk_map(t.applications, "owner_id", t.users, "atlas_id", "atlas_owner_id", default=CTX.master()).select("id", "atlas_owner_id")


@query("j03_same_lookup_thrice", f"""
SELECT p.id, coalesce(a.atlas_id, '{MASTER}') AS owner, coalesce(b.atlas_id, '{MASTER}') AS creator, c.atlas_id AS updater FROM {POSTINGS} p
LEFT JOIN {USERS} a ON a.id = p.owner_id LEFT JOIN {USERS} b ON b.id = (p.owner_id + 7) % 25 LEFT JOIN {USERS} c ON c.id = p.owner_id + 1""")
def _(t: Tables):
    rows = joins.fk_map(t.postings, "owner_id", t.users, "atlas_id", "owner", default=CTX.master())
    rows = joins.fk_map(rows, (F.col("owner_id") + 7) % 25, t.users, "atlas_id", "creator", default=CTX.master())
    return joins.fk_map(rows, F.col("owner_id") + 1, t.users, "atlas_id", "updater").select("id", "owner", "creator", "updater")


_OWNER_TEXT = "CASE WHEN id % 3 = 0 THEN 'NATION_' || CAST(owner_id AS STRING) WHEN id % 3 = 1 THEN CAST(owner_id AS STRING) ELSE 'nobody' END"


@query("j04_id_then_name", f"""
SELECT p.id, coalesce(a.atlas_id, b.atlas_id, '{MASTER}') AS owner FROM (SELECT id, {_OWNER_TEXT} AS o FROM {POSTINGS}) p
LEFT JOIN {USERS} a ON CAST(a.id AS VARCHAR) = p.o LEFT JOIN {USERS} b ON b.name = p.o""")
def _(t: Tables):
    rows = t.postings.selectExpr("id", f"{_OWNER_TEXT} AS o")
    return joins.lookup_chain(rows, "o", t.users, ["id", "name"], "atlas_id", "owner", CTX.master()).select("id", "owner")


@query("j05_three_way_lookup", f"""
SELECT p.id, coalesce(a.atlas_id, b.atlas_id, c.atlas_id) AS owner FROM (SELECT id, CASE WHEN id % 4 = 3 THEN 'user' || CAST(owner_id AS STRING) || '@corp.example.com' ELSE {_OWNER_TEXT} END AS o FROM {POSTINGS}) p
LEFT JOIN {USERS} a ON CAST(a.id AS VARCHAR) = p.o LEFT JOIN {USERS} b ON b.name = p.o LEFT JOIN {USERS} c ON c.email = p.o""")
def _(t: Tables):
    rows = t.postings.selectExpr("id", f"CASE WHEN id % 4 = 3 THEN 'user' || CAST(owner_id AS STRING) || '@corp.example.com' ELSE {_OWNER_TEXT} END AS o")
    return joins.lookup_chain(rows, "o", t.users, ["id", "name", "email"], "atlas_id", "owner").select("id", "owner")


@query("j06_multi_column", """
SELECT DISTINCT a.l_orderkey, a.l_suppkey FROM lineitem a JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R') b
ON a.l_orderkey = b.l_orderkey AND a.l_suppkey = b.l_suppkey WHERE a.l_returnflag = 'N'""")
def _(t: Tables):
    keys = ["l_orderkey", "l_suppkey"]
    rows = t.lineitem.select(*keys, "l_returnflag")
    return rows.where("l_returnflag = 'N'").join(rows.where("l_returnflag = 'R'").select(*keys), keys, "left_semi").select(*keys).distinct()


@query("j07_using", f"SELECT person_id, a.id, q.name FROM {APPS} a JOIN (SELECT id AS person_id, name FROM {PEOPLE}) q USING (person_id)")
def _(t: Tables):
    return t.applications.join(t.people.selectExpr("id AS person_id", "name"), ["person_id"]).select("person_id", "id", "name")


@query("j08_text_join", f"""
SELECT x.id, min(c.id) AS company_id FROM (SELECT id, upper(company_name) || '  ' AS n FROM {CONTACTS}) x LEFT JOIN {COMPANIES} c
ON lower(trim(x.n)) = lower(trim(c.name)) GROUP BY x.id""")
def _(t: Tables):
    rows = t.contacts.select("id", F.concat(F.upper("company_name"), F.lit("  ")).alias("n"))
    return joins.lookup_by_text(rows, "n", t.companies, "name", {"company_id": "id"}).select("id", "company_id")


@query("j09_prefix_stripped", f"""
SELECT t.id, c.atlas_id FROM (SELECT id, 'COMPANY:' || CAST(company_id AS VARCHAR) AS link FROM {POSTINGS}) t JOIN {COMPANIES} c
ON CAST(c.id AS VARCHAR) = regexp_replace(trim(t.link), '^COMPANY:', '')""")
def _(t: Tables):
    link = F.concat(F.lit("COMPANY:"), F.col("company_id").cast("string"))
    rows = t.postings.select("id", link.alias("link"))
    key = F.regexp_replace(F.trim("link"), "^COMPANY:", "").try_cast("bigint")
    return joins.fk_map(rows, key, t.companies, "atlas_id", "atlas_id", policy="exclude").select("id", "atlas_id")


@query("j10_trailing_slash", f"""
SELECT a.id, min(b.id) AS candidate_id FROM {B_SIDE} a JOIN {A_SIDE} b ON rtrim(a.linkedin, '/') = rtrim(b.linkedin, '/')
WHERE a.linkedin <> '' AND b.linkedin <> '' GROUP BY a.id""")
def _(t: Tables):
    key = F.rtrim("linkedin", F.lit("/"))
    found = joins.match_any_key(t.contact_people, "id", t.candidate_people, "id", [("linkedin", key, key)])
    return found.select("id", F.col("match_id").alias("candidate_id"))


def _nb(x: str) -> str:
    return f"nullif(trim({x}), '')"


@query("j11_match_any_key", f"""
SELECT ct.id, min(c.id) AS match_id FROM {B_SIDE} ct JOIN {A_SIDE} c ON {_nb(d_email('c.email'))} = {_nb(d_email('ct.email'))}
  OR {d_phone('c.phone')} = {d_phone('ct.phone')} OR {_nb(d_linkedin('c.linkedin'))} = {_nb(d_linkedin('ct.linkedin'))} GROUP BY ct.id""")
def _(t: Tables):
    keys = [("email", contact.email_norm("email"), contact.email_norm("email")),
            ("phone", contact.phone_norm("phone"), contact.phone_norm("phone")),
            ("linkedin", contact.linkedin_norm("linkedin"), contact.linkedin_norm("linkedin"))]
    return joins.match_any_key(t.contact_people, "id", t.candidate_people, "id", keys)


_OWN = "CASE WHEN id % 3 = 0 THEN NULL ELSE person_id END"


@query("j12_guarded_match", f"""
SELECT a.id, min(p.id) AS match_id FROM (SELECT id, {_OWN} AS own, 'Supplier#' || lpad(CAST(person_id AS VARCHAR), 9, '0') AS ext FROM {APPS}) a
JOIN {PEOPLE} p ON p.id = a.own OR (p.name = a.ext AND a.own IS NULL) GROUP BY a.id""")
def _(t: Tables):
    rows = t.applications.selectExpr("id", f"{_OWN} AS own", "'Supplier#' || lpad(CAST(person_id AS STRING), 9, '0') AS ext")
    return joins.match_id_or_external(rows, "id", "own", "ext", t.people, "id", "name").groupBy("id").agg(F.min("match_id").alias("match_id"))


@query("j13_extra_condition", f"""
SELECT a.id, p.last_out FROM {APPS} a LEFT JOIN (SELECT person_id, max(added_at) AS m, {d_iso('max(added_at)')} AS last_out FROM {APPS} WHERE flag = 'R' GROUP BY person_id) p
ON p.person_id = a.person_id AND a.flag = 'A'""")
def _(t: Tables):
    last = joins.one_per_key(t.applications.where("flag = 'R'"), [F.col("person_id").alias("_p")], dates.iso(F.max("added_at")).alias("last_out"))
    return t.applications.join(last, (F.col("person_id") == F.col("_p")) & (F.col("flag") == "A"), "left").select("id", "last_out")


@query("j14_constant_key", f"SELECT o.id, f.fee_type FROM {POSTINGS} o JOIN (SELECT 'fee-1' AS fee_type, '{CTX.agency_id}' AS agency_id) f ON f.agency_id = '{CTX.agency_id}'")
def _(t: Tables):
    return joins.with_constant(t.postings.select("id"), constant_row(t.spark, fee_type="fee-1"))


_ATTRS = (("Brand", "att-1"), ("Kind", "att-2"))


@query("j15_attribute_row", """
SELECT p.id, p.brand AS value, a.attribute_id FROM (SELECT p_partkey AS id, p_brand AS brand FROM part) p
CROSS JOIN (SELECT 'Brand' AS name, 'att-1' AS attribute_id UNION ALL SELECT 'Kind', 'att-2') a WHERE a.name = 'Brand'""")
def _(t: Tables):
    one = literal_relation(t.spark, ("name", "attribute_id"), _ATTRS).where("name = 'Brand'").select("attribute_id")
    return joins.with_constant(t.attribute_rows.select("id", F.col("brand").alias("value")), one)


@query("j16_parent_child", f"""
SELECT c.id AS child, p.id AS parent, p.atlas_id AS atlas_parent FROM (SELECT id, CASE WHEN id % 4 = 0 THEN CAST(floor(id / 4) AS BIGINT) END AS parent_id FROM {COMPANIES}) c
JOIN {COMPANIES} p ON p.id = c.parent_id""")
def _(t: Tables):
    rows = t.companies.selectExpr("id AS child", "CASE WHEN id % 4 = 0 THEN id div 4 END AS parent")
    return joins.fk_map(rows, "parent", t.companies, "atlas_id", "atlas_parent", policy="exclude")


@query("j17_bridge_chain", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, r.r_name FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey WHERE l.l_returnflag = 'A'""")
def _(t: Tables):
    rows = t.lineitem.where("l_returnflag = 'A'").select("l_orderkey", "l_linenumber", "l_partkey")
    steps = ((t.orders, "o_orderkey", "o_custkey", "l_orderkey"), (t.customer, "c_custkey", "c_nationkey", "o_custkey"),
             (t.nation, "n_nationkey", "n_regionkey", "c_nationkey"), (t.region, "r_regionkey", "r_name", "n_regionkey"))
    for ref, key, value, fk in steps:
        rows = joins.fk_map(rows, fk, ref, value, value, ref_key=key, policy="exclude")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "r_name")


_DUPES = "(SELECT s_suppkey AS contact_id, s_suppkey + 1 AS candidate_id FROM supplier WHERE s_suppkey % 6 = 0)"


@query("j18_rekey_duplicates", f"""
SELECT a.id, a.person_id FROM {APPS} a JOIN {PEOPLE} p ON p.id = a.person_id WHERE a.person_id NOT IN (SELECT contact_id FROM {_DUPES})
UNION ALL SELECT a.id, d.candidate_id FROM {APPS} a JOIN {_DUPES} d ON d.contact_id = a.person_id JOIN {PEOPLE} p ON p.id = d.candidate_id""")
def _(t: Tables):
    dupes = t.supplier.where("s_suppkey % 6 = 0").selectExpr("s_suppkey AS contact_id", "s_suppkey + 1 AS candidate_id")
    return joins.drop_orphans(joins.survivor_key(t.applications, "person_id", dupes), "person_id", t.people).select("id", "person_id")


@query("j19_anti_left_null", f"SELECT a.id FROM {APPS} a LEFT JOIN {PROJECTS} p ON p.id = a.project_id WHERE p.id IS NULL")
def _(t: Tables):
    return joins.exclude(t.applications, "project_id", t.projects).select("id")


@query("j20_not_in", f"SELECT id FROM {POSTINGS} WHERE id NOT IN (SELECT linked_id FROM {POSTINGS} WHERE linked_id IS NOT NULL)")
def _(t: Tables):
    return joins.exclude(t.postings, "id", t.postings, "linked_id", unique=True).select("id")


@query("j21_in_or_in", "SELECT c_custkey AS id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') OR c_custkey IN (SELECT user_id FROM events)")
def _(t: Tables):
    ids = t.customer.select(F.col("c_custkey").alias("id"))
    return joins.keep_any(ids, "id", (t.orders.where("o_orderstatus = 'P'"), "o_custkey"), (t.events, "user_id"))


@query("j22_exists_flag", "SELECT o.o_orderkey, EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R') AS has_return FROM orders o")
def _(t: Tables):
    return joins.exists_flag(t.orders.select("o_orderkey"), "o_orderkey", t.lineitem.where("l_returnflag = 'R'"), "l_orderkey", "has_return")


@query("j23_nearest_in_time", """
SELECT id, cand FROM (SELECT m.event_id AS id, b.event_id AS cand, row_number() OVER (PARTITION BY m.event_id
  ORDER BY abs(date_diff('second', date_trunc('second', m.ts), date_trunc('second', b.ts))), b.event_id DESC) AS rn
  FROM (SELECT * FROM events WHERE event_type = 'purchase') m LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') b ON b.user_id = m.user_id) WHERE rn = 1""")
def _(t: Tables):
    meetings = t.events.where("event_type = 'purchase'").selectExpr("event_id AS id", "user_id", "ts")
    views = t.events.where("event_type = 'view'")
    return joins.nearest_in_time(meetings, "user_id", "ts", views, "ts", "event_id", "cand").select("id", "cand")


@query("j24_prior_event", f"""
WITH latest AS (SELECT person_id, max(ts) AS ts FROM {HISTORY} GROUP BY person_id),
prior AS (SELECT h.person_id, h.status, row_number() OVER (PARTITION BY h.person_id ORDER BY h.ts DESC, h.event_id DESC) AS rn FROM {HISTORY} h JOIN latest l USING (person_id)
          WHERE h.ts < l.ts AND h.status <> 'error')
SELECT person_id, status FROM prior WHERE rn = 1""")
def _(t: Tables):
    return history.prior_status(t.history, ["person_id"], "status", "ts", "event_id", F.col("status") != "error")


@query("j25_value_and_attribute", """
SELECT p.p_partkey AS id, o.option_id FROM part p JOIN (SELECT p_type AS attribute, p_brand AS value, p_type || '/' || p_brand AS option_id FROM part GROUP BY 1, 2) o
ON o.value = p.p_brand AND o.attribute = p.p_type""")
def _(t: Tables):
    options = t.part.selectExpr("p_type", "p_brand", "p_type || '/' || p_brand AS option_id").distinct()
    return t.part.join(options, ["p_brand", "p_type"]).select(F.col("p_partkey").alias("id"), "option_id")


@query("j26_derived_key", f"SELECT c.id, p.atlas_id FROM {CONTACTS} c JOIN {COMPANIES} p ON p.id = TRY_CAST(regexp_replace(c.company_name, '[^0-9]', '', 'g') AS BIGINT)")
def _(t: Tables):
    key = F.regexp_replace("company_name", "[^0-9]", "").try_cast("bigint")
    return joins.fk_map(t.contacts.select("id", "company_name"), key, t.companies, "atlas_id", "atlas_id", policy="exclude").select("id", "atlas_id")


# -- aggregates ------------------------------------------------------------------------------------------------

@query("a01_first_last", f"SELECT project_id, {d_iso('max(added_at)')} AS last_at, {d_iso('min(added_at)')} AS first_at FROM {APPS} GROUP BY project_id")
def _(t: Tables):
    return t.applications.groupBy("project_id").agg(dates.iso(F.max("added_at")).alias("last_at"), dates.iso(F.min("added_at")).alias("first_at"))


@query("a02_min_representative", f"SELECT project_id, min(id) AS id FROM {APPS} GROUP BY project_id")
def _(t: Tables):
    return t.applications.groupBy("project_id").agg(F.min("id").alias("id"))


@query("a03_exactly_once", f"SELECT {d_phone('phone')} AS value, min(id) AS id FROM {CONTACTS} GROUP BY 1 HAVING count(*) = 1")
def _(t: Tables):
    return dedupe.occurring_once(t.contacts.select(contact.phone_norm("phone").alias("value"), "id"), "value", "id")


@query("a04_settings_pivot", """
SELECT user_id, max(CASE WHEN event_type = 'view' THEN props END) AS view, max(CASE WHEN event_type = 'click' THEN props END) AS click,
  max(CASE WHEN event_type = 'signup' THEN props END) AS signup FROM events GROUP BY user_id""")
def _(t: Tables):
    return reshape.settings_to_columns(t.events, "user_id", "event_type", "props", ["view", "click", "signup"])


@query("a05_ordered_text", """
SELECT conv_id, string_agg('- ' || role || ': ' || trim(text), chr(10) ORDER BY turn) AS body FROM conversations WHERE text IS NOT NULL AND trim(text) <> '' GROUP BY conv_id""")
def _(t: Tables):
    piece = F.when(F.trim("text") != "", F.concat(F.lit("- "), "role", F.lit(": "), F.trim("text")))
    return reshape.ordered_text(t.conversations, ["conv_id"], ["turn"], piece, "\n", "body")


@query("a06_distinct", "SELECT DISTINCT p_type, p_brand FROM part")
def _(t: Tables):
    return t.part.select("p_type", "p_brand").distinct()


@query("a07_max_or_now", f"""
SELECT o.o_orderkey, strftime(coalesce(max(l.l_shipdate), CAST('{NOW}' AS TIMESTAMP)), '%Y-%m-%dT%H:%M:%S') AS at FROM orders o
LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'A' GROUP BY o.o_orderkey""")
def _(t: Tables):
    last = joins.one_per_key(t.lineitem.where("l_returnflag = 'A'"), [F.col("l_orderkey").alias("o_orderkey")], F.max("l_shipdate").alias("_at"))
    return t.orders.select("o_orderkey").join(last, "o_orderkey", "left").select("o_orderkey", dates.iso(F.coalesce("_at", CTX.now())).alias("at"))


@query("a08_duplicate_count", "SELECT count(*) - count(DISTINCT l_orderkey) AS extra FROM lineitem")
def _(t: Tables):
    return t.lineitem.groupBy("l_orderkey").count().agg(F.sum(F.col("count") - 1).alias("extra"))


@query("a09_null_fraction", f"SELECT CAST(round(1000.0 * count(*) FILTER (email IS NULL) / count(*)) AS BIGINT) AS email, CAST(round(1000.0 * count(*) FILTER (city IS NULL) / count(*)) AS BIGINT) AS city FROM {CONTACTS}")
def _(t: Tables):
    share = lambda c: F.round(1000.0 * F.count_if(F.col(c).isNull()) / F.count(F.lit(1))).cast("bigint").alias(c)
    return t.contacts.agg(share("email"), share("city"))


@query("a10_conditional_counts", f"SELECT count(*) FILTER (has_company) AS yes, count(*) FILTER (NOT has_company) AS no, count(*) FILTER (has_company IS NULL) AS missing FROM {CONTACTS}")
def _(t: Tables):
    return t.contacts.agg(F.count_if("has_company").alias("yes"), F.count_if(~F.col("has_company")).alias("no"), F.count_if(F.col("has_company").isNull()).alias("missing"))


@query("a11_duplicate_groups", "SELECT l_orderkey, l_suppkey, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY 3 DESC, 1, 2 LIMIT 10")
def _(t: Tables):
    return repeated_values(t.lineitem, ["l_orderkey", "l_suppkey"], 10)


@query("a12_scalar_min", "SELECT min(o_orderpriority) AS low, min(o_orderpriority) = max(o_orderpriority) AS constant FROM orders")
def _(t: Tables):
    return t.orders.agg(F.min("o_orderpriority").alias("low"), (F.min("o_orderpriority") == F.max("o_orderpriority")).alias("constant"))


@query("a13_column_maxima", f"SELECT project_id, max(person_id) AS person_id, max(flag) AS flag, max(line) AS line FROM {APPS} GROUP BY project_id")
def _(t: Tables):
    return dedupe.column_maxima(t.applications.select("project_id", "person_id", "flag", "line"), ["project_id"])


@query("a14_group_by_all", "SELECT l_suppkey, l_returnflag, l_linestatus FROM lineitem GROUP BY 1, 2, 3")
def _(t: Tables):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


# -- windows ---------------------------------------------------------------------------------------------------

@query("w01_keep_first", """
SELECT l_orderkey, l_suppkey, l_partkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey
  ORDER BY l_shipdate DESC, l_partkey, l_linenumber, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""")
def _(t: Tables):
    order = [F.col("l_shipdate").desc_nulls_last(), F.col("l_partkey").asc(), F.col("l_linenumber").asc(), F.col("l_extendedprice").asc()]
    return dedupe.keep_first(t.lineitem, ["l_orderkey", "l_suppkey"], order).select("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber")


@query("w02_priority", f"""
SELECT person_id, id, flag FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY CASE flag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 9 END, added_at DESC, id) AS rn
FROM {APPS}) WHERE rn = 1""")
def _(t: Tables):
    order = [dedupe.priority("flag", ("R", "A")), F.col("added_at").desc_nulls_last(), F.col("id").asc()]
    return dedupe.keep_first(t.applications, ["person_id"], order).select("person_id", "id", "flag")


@query("w03_prefer_filled", f"""
SELECT owner_id, id, city FROM (SELECT *, row_number() OVER (PARTITION BY owner_id ORDER BY (city IS NULL OR city = '') ASC, added_at, id) AS rn FROM {CONTACTS}) WHERE rn = 1""")
def _(t: Tables):
    order = [dedupe.filled_first("city"), F.col("added_at").asc_nulls_last(), F.col("id").asc()]
    return dedupe.keep_first(t.contacts, ["owner_id"], order).select("owner_id", "id", "city")


@query("w04_nulls_last", f"""
SELECT project_id, candidate_id, id FROM (SELECT *, row_number() OVER (PARTITION BY project_id, candidate_id ORDER BY offer DESC NULLS LAST, interview1 DESC NULLS LAST, id) AS rn
FROM {_STAGES}) WHERE rn = 1""")
def _(t: Tables):
    order = [F.col("offer").desc_nulls_last(), F.col("interview1").desc_nulls_last(), F.col("id").asc()]
    return dedupe.keep_first(t.stages, ["project_id", "candidate_id"], order).select("project_id", "candidate_id", "id")


@query("w05_address_choice", f"""
SELECT owner_id, id, address1 FROM (SELECT *, row_number() OVER (PARTITION BY owner_id ORDER BY CASE WHEN nullif(trim(address1), '') IS NULL THEN 1 ELSE 0 END, id) AS rn FROM {CONTACTS}) WHERE rn = 1""")
def _(t: Tables):
    order = [dedupe.filled_first(F.trim("address1")), F.col("id").asc()]
    return dedupe.keep_first(t.contacts, ["owner_id"], order).select("owner_id", "id", "address1")


@query("w06_primary_record", f"""
SELECT owner_id, id FROM (SELECT *, row_number() OVER (PARTITION BY owner_id ORDER BY CASE WHEN linked_id IS NOT NULL AND has_company THEN 0 WHEN linked_id IS NOT NULL AND NOT has_company THEN 1
  WHEN linked_id IS NULL AND has_company THEN 2 ELSE 3 END, modified_at DESC NULLS LAST, id DESC) AS rn FROM {CONTACTS}) WHERE rn = 1""")
def _(t: Tables):
    rank = F.when(F.col("linked_id").isNotNull(), F.when(F.col("has_company"), 0).otherwise(1)).otherwise(F.when(F.col("has_company"), 2).otherwise(3))
    return dedupe.keep_first(t.contacts, ["owner_id"], [rank, F.col("modified_at").desc_nulls_last(), F.col("id").desc()]).select("owner_id", "id")


@query("w07_normalised_key", f"""
SELECT id, key FROM (SELECT id, {d_email('email')} AS key, row_number() OVER (PARTITION BY {d_email('email')} ORDER BY added_at DESC, id) AS rn FROM {CONTACTS}) WHERE rn = 1""")
def _(t: Tables):
    rows = t.contacts.select("id", "added_at", contact.email_norm("email").alias("key"))
    return dedupe.keep_first(rows, ["key"], [F.col("added_at").desc_nulls_last(), F.col("id").asc()]).select("id", "key")


@query("w08_first_flag", f"SELECT id, row_number() OVER (PARTITION BY person_id ORDER BY added_at DESC, id) = 1 AS favourite FROM {APPS}")
def _(t: Tables):
    rows = t.applications.select("id", "person_id", "added_at")
    return dedupe.flag_first(rows, ["person_id"], [F.col("added_at").desc_nulls_last(), F.col("id").asc()], ["id"], "favourite").select("id", "favourite")


@query("w09_positions", "SELECT p_type, p_name, p_partkey, CAST(row_number() OVER (PARTITION BY p_type ORDER BY p_name, p_partkey) AS INT) AS position FROM part")
def _(t: Tables):
    return numbering.number_within(t.part.select("p_type", "p_name", "p_partkey"), ["p_type"], ["p_name", "p_partkey"])


@query("w10_first_holder", f"""
SELECT id, CASE WHEN row_number() OVER (PARTITION BY job_number ORDER BY added_at, id) = 1 THEN job_number END AS job_number FROM {POSTINGS}""")
def _(t: Tables):
    rows = t.postings.select("id", "job_number", "added_at")
    return dedupe.on_first_holder_only(rows, "job_number", [F.col("added_at").asc_nulls_last(), F.col("id").asc()], ["id"]).select("id", "job_number")


@query("w11_two_stage", f"""
WITH a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY person_id, flag ORDER BY added_at DESC, id) AS r1 FROM {APPS}) WHERE r1 = 1)
SELECT id, flag, owner_id FROM (SELECT *, row_number() OVER (PARTITION BY owner_id ORDER BY flag, id) AS r2 FROM a) WHERE r2 = 1""")
def _(t: Tables):
    inner = (["person_id", "flag"], [F.col("added_at").desc_nulls_last(), F.col("id").asc()])
    return dedupe.two_stage(t.applications, inner, (["owner_id"], [F.col("flag").asc(), F.col("id").asc()])).select("id", "flag", "owner_id")


@query("w12_arbitrary_pick", f"SELECT person_id, id FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY id) AS rn FROM {APPS}) WHERE rn = 1")
def _(t: Tables):
    return dedupe.keep_first(t.applications, ["person_id"], [F.col("id").asc()]).select("person_id", "id")


@query("w13_current_position", f"""
SELECT owner_id, segment, id FROM (SELECT *, row_number() OVER (PARTITION BY owner_id, segment ORDER BY added_at DESC NULLS LAST, id DESC) AS rn
FROM {CONTACTS} WHERE has_company OR linked_id IS NULL) WHERE rn = 1""")
def _(t: Tables):
    rows = t.contacts.selectExpr("id", "owner_id", "segment", "has_company AS is_active", "added_at AS started_at", "linked_id AS finished_at")
    return current_position(rows, ["owner_id", "segment"]).select("owner_id", "segment", "id")


@query("w14_numbered_links", """
SELECT note_id, person_id, CAST(row_number() OVER (PARTITION BY note_id ORDER BY person_id) AS INT) AS n
FROM (SELECT DISTINCT l_orderkey AS note_id, l_suppkey AS person_id FROM lineitem)""")
def _(t: Tables):
    pairs = t.lineitem.selectExpr("l_orderkey AS note_id", "l_suppkey AS person_id").distinct()
    return numbering.number_within(pairs, ["note_id"], ["person_id"], "n")


@query("w15_global_numbering", "SELECT value, CAST(row_number() OVER (ORDER BY value) AS INT) AS position FROM (SELECT DISTINCT p_brand AS value FROM part)")
def _(t: Tables):
    return numbering.number_within(t.part.selectExpr("p_brand AS value").distinct(), [], ["value"])


# -- sorts and set operations ----------------------------------------------------------------------------------

@query("o02_sample", f"SELECT id, email FROM {CONTACTS} WHERE email LIKE '%@%@%' ORDER BY id LIMIT 5")
def _(t: Tables):
    return t.contacts.where(F.col("email").like("%@%@%")).select("id", "email").orderBy("id").limit(5)


@query("o03_top_k", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def _(t: Tables):
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "o_custkey").limit(10)


@query("u01_union_all", f"SELECT id, 'person' AS kind FROM {PEOPLE} UNION ALL SELECT id, 'company' FROM {COMPANIES}")
def _(t: Tables):
    return reshape.union_all(t.people.select("id", F.lit("person").alias("kind")), t.companies.select(F.lit("company").alias("kind"), "id"))


@query("u02_union_distinct", "SELECT o_custkey AS id FROM orders UNION SELECT user_id FROM events UNION SELECT l_suppkey FROM lineitem")
def _(t: Tables):
    return reshape.union_distinct(t.orders.selectExpr("o_custkey AS id"), t.events.selectExpr("user_id AS id"), t.lineitem.selectExpr("l_suppkey AS id"))


@query("u03_unpivot", f"""
SELECT id, 'email' AS type, {d_email('email')} AS value FROM {CONTACTS} WHERE {d_email('email')} IS NOT NULL
UNION ALL SELECT id, 'phone', {d_phone('phone')} FROM {CONTACTS} WHERE {d_phone('phone')} IS NOT NULL
UNION ALL SELECT id, 'mobile', {d_phone('mobile')} FROM {CONTACTS} WHERE {d_phone('mobile')} IS NOT NULL
UNION ALL SELECT id, 'linkedin', {d_linkedin('linkedin')} FROM {CONTACTS} WHERE {d_linkedin('linkedin')} IS NOT NULL""")
def _(t: Tables):
    values = {"email": contact.email_norm("email"), "phone": contact.phone_norm("phone"), "mobile": contact.phone_norm("mobile"),
              "linkedin": contact.linkedin_norm("linkedin")}
    return reshape.unpivot(t.contacts, ["id"], [{"type": F.lit(k), "value": v} for k, v in values.items()])


@query("u04_union_then_dedupe", f"""
SELECT id, person_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY person_id) AS rn FROM (
  SELECT a.id, a.person_id FROM {APPS} a WHERE a.person_id NOT IN (SELECT contact_id FROM {_DUPES})
  UNION ALL SELECT a.id, d.candidate_id FROM {APPS} a JOIN {_DUPES} d ON d.contact_id = a.person_id)) WHERE rn = 1""")
def _(t: Tables):
    dupes = t.supplier.where("s_suppkey % 6 = 0").selectExpr("s_suppkey AS contact_id", "s_suppkey + 1 AS candidate_id")
    rows = joins.survivor_key(t.applications.select("id", "person_id"), "person_id", dupes)
    return dedupe.keep_first(rows, ["id"], [F.col("person_id").asc()])


@query("u05_tagged_values", """
SELECT DISTINCT 'kind' AS alias, trim(p_type) AS value FROM part WHERE trim(p_type) <> '' UNION ALL SELECT DISTINCT 'brand', trim(p_brand) FROM part
UNION ALL SELECT DISTINCT 'segment', trim(c_mktsegment) FROM customer""")
def _(t: Tables):
    return reshape.tagged_values({"kind": (t.part, F.col("p_type")), "brand": (t.part, F.col("p_brand")),
                                  "segment": (t.customer, F.col("c_mktsegment"))})


@query("u06_key_sets", """
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'left' WHEN a.k IS NULL THEN 'right' ELSE 'both' END AS side
FROM (SELECT DISTINCT o_custkey AS k FROM orders) a FULL JOIN (SELECT DISTINCT user_id AS k FROM events) b ON a.k = b.k""")
def _(t: Tables):
    sides = reshape.union_all(t.orders.selectExpr("o_custkey AS k", "true AS l"), t.events.selectExpr("user_id AS k", "false AS l"))
    seen = sides.groupBy("k").agg(F.max("l").alias("a"), F.max(~F.col("l")).alias("b"))
    return seen.select("k", F.when(~F.col("b"), "left").when(~F.col("a"), "right").otherwise("both").alias("side"))


@query("f40_explode_list", f"""
SELECT DISTINCT id, trim(item) AS item FROM (SELECT id, unnest(string_split(replace(list_text, ';', ','), ',')) AS item FROM {CONTACTS}
WHERE list_text IS NOT NULL) WHERE trim(item) <> ''""")
def _(t: Tables):
    return reshape.explode_list(t.contacts.select("id", "list_text"), "list_text", "item").select("id", "item").distinct()
