"""CRM-shaped relations derived from the test tables, with the dirt real exports have."""

from __future__ import annotations

from .base import FIXTURES, Fixture, id_sql, text


def _case(k: str, *cells: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(cells[:-1]))
    return f"(CASE {k} % {len(cells)} {arms} ELSE {cells[-1]} END)"


def email(k: str) -> str:
    s = text(k)
    return _case(k, "NULL", "''", f"'  John.' || {s} || '@GMAIL.com '", f"'anna' || {text(f'{k} % 300')} || '@corp.co.uk'",
                 f"'nodot' || {s} || '@corp'", f"'two' || {s} || '@x@y.com'", f"'<eve' || {s} || '@yahoo.com>;'",
                 f"'user' || {s} || '@mailinator.com'")


def phone(k: str) -> str:
    s = text(k)
    return _case(k, "NULL", f"'+44 20 7946 ' || {text(f'{k} % 400')}", f"'0044 20 ' || {s}", f"'(020) 7946-' || {s}",
                 "'ext only'", "'+'", f"'07700 ' || {s} || ' / 07711 ' || {s}", text(f"7000000 + {k}"))


def linkedin(k: str) -> str:
    s = text(k)
    return _case(k, f"'https://www.linkedin.com/in/p' || {text(f'{k} % 250')} || '/'", f"'http://linkedin.com/in/P' || {s}",
                 f"'www.linkedin.com/in/ p' || {s} || ' '", "'n/a'", f"'linkedin.com/in/q' || {s} || '//'", "NULL",
                 f"'https://uk.linkedin.com/in/r' || {s} || '?trk=1'", "''")


def website(k: str) -> str:
    s = text(k)
    return _case(k, f"'https://www.Site' || {s} || '.com/'", f"'http://site' || {s} || '.org'", "'www.Shared.com'",
                 f"' site' || {s} || '.net '", "NULL", "'linkedin.com/company/x'", "'nosite'",
                 f"'https://twitter.com/h' || {s}")


def salary_text(k: str) -> str:
    return _case(k, "'50,000 - 60,000'", "'45000'", "'NA'", "''", f"'£7' || {text(f'{k} % 10')} || 'k'", "'80.5'", "NULL",
                 "'negotiable'")


def list_text(k: str) -> str:
    s = text(f"{k} % 20")
    return _case(k, f"'a,b' || {s}", "'a;b;c'", "'a,,b'", "' a , b '", f"'only' || {s}", "''", "NULL",
                 "'a1,a2,a3,a4,a5,a6,a7,a8,a9,a10,a11,a12'")


def html(k: str) -> str:
    s = text(k)
    return _case(k, f"'<h1>Role ' || {s} || '</h1><p>Lead <b>team</b></p>'", "'plain text'", "NULL", "''",
                 f"'<ul><li>one</li><li>two ' || {s} || '</li></ul>'", "'R&amp;D <em>fast</em><br/>line'",
                 "'<script>var x=1;</script>kept'", "'this is a DUMMY job, ignore'")


def moment(k: str) -> str:
    """A timestamp from 2010 to 2023, spread by the key."""
    k = f"({k})"

    def two(e: str) -> str:
        return f"lpad({text(e)}, 2, '0')"
    return (f"CAST('20' || {two(f'10 + {k} % 14')} || '-' || {two(f'1 + {k} % 12')} || '-' || {two(f'1 + {k} % 28')} "
            f"|| ' ' || {two(f'{k} % 24')} || ':30:15' AS TIMESTAMP)")


def name_with_dirt(k: str) -> str:
    s = text(k)
    return _case(k, f"'Mary Ann Smith' || {s}", "'Prince'", f"'Bob Jones (ex ' || {s} || ')'", "'Eve (open remark'", "''",
                 "NULL", f"'x' || {s} || '@mail.com'", "' padded name '")


COMPANY_STATUS = ("Active", " terms signed ", "Archive", "prospect", "UNKNOWN", "NULL")
RESPONSE_STATUS = ("Placed", "1st Interview", "Rejected", "Offer Rejected", "CV Sent ", "Screened", "client rejected",
                   "candidate not interested", "Interview/Rejected", "mystery")
PROJECT_STATUS = ("Open", "On Hold", "Placed", "Cancelled", "Qualifying", "converted", "spec cv sent", "odd")


def listed(k: str, values: tuple[str, ...]) -> str:
    return _case(k, *["NULL" if v == "NULL" else f"'{v}'" for v in values])


_C, _S, _O, _L = "c_custkey", "s_suppkey", "o_orderkey", "l_orderkey"


def unknown(k: str, condition: str) -> str:
    """The key, or, where the condition holds, one that nothing refers to: references to such rows are orphans."""
    return f"(CASE WHEN {condition} THEN -1 - {k} ELSE {k} END)"


def unknown_name(name: str, condition: str) -> str:
    return f"(CASE WHEN {condition} THEN 'left ' || {name} ELSE {name} END)"


_NATION, _PERSON = unknown("n_nationkey", "n_nationkey % 5 = 3"), unknown(_S, "s_suppkey % 11 = 3")
_FIRM, _PROJECT = unknown(_C, "c_custkey % 13 = 4"), unknown(_O, "o_orderkey % 17 = 5")

FIXTURES.update({
    # staff: nation
    "staff": Fixture("nation", {
        "id": "n_nationkey", "first_name": "'User'", "last_name": "n_name",
        "email": _case("n_nationkey", "'USER' || CAST(n_nationkey AS STRING) || '@corp.example.com'",
                       "'user' || CAST(n_nationkey AS STRING) || '-corp.example.com'",
                       "' user' || CAST(n_nationkey AS STRING) || '@corp.example.com'", "'someone@other.com'",
                       "'shared@corp.example.com'"),
        "added_at": moment("n_nationkey"), "modified_at": moment("n_nationkey + 5")}),
    "prior_users": Fixture("nation", {
        "atlas_id": "'kept-' || CAST(n_nationkey AS STRING)",
        "email": "CASE WHEN n_nationkey % 2 = 0 THEN 'user' ELSE 'gone' END || CAST(n_nationkey AS STRING) || '@CORP.example.com'",
        "name": _case("n_nationkey", "'Known Name'", "' '", "NULL"), "status": "'active'"}),
    "users": Fixture("nation", {
        "id": _NATION, "atlas_id": id_sql(_NATION), "name": unknown_name("n_name", "n_nationkey % 5 = 3"),
        "email": f"'user' || CAST({_NATION} AS STRING) || '@corp.example.com'", "status": "'active'"}),
    # references
    "people": Fixture("supplier", {"id": _PERSON, "atlas_id": id_sql(_PERSON), "name": "s_name"}),
    "companies": Fixture("customer", {"id": _FIRM, "atlas_id": id_sql(_FIRM), "name": "c_name", "nation_id": "c_nationkey"}),
    "projects": Fixture("orders", {"id": _PROJECT, "atlas_id": id_sql(_PROJECT), "company_id": "o_custkey", "created_at": "o_orderdate",
                                   "owner_id": "o_custkey % 25"}),
    # wide source rows
    "contacts": Fixture("customer", {
        "id": _C, "name": name_with_dirt(_C), "company_name": "c_name", "email": email(_C), "email2": email(f"({_C} + 3)"),
        "phone": phone(_C), "phone2": phone(f"({_C} + 2)"), "mobile": phone(f"({_C} + 5)"), "workphone": phone(f"({_C} + 7)"),
        "linkedin": linkedin(_C), "linkedin2": linkedin(f"({_C} + 1)"), "website": website(_C),
        "salary_text": salary_text(_C), "list_text": list_text(_C), "html": html(_C),
        "address1": _case(_C, "'10 High St.'", "''", "NULL", "'N/A'"), "address2": _case(_C, "'Flat #2'", "NULL", "''"),
        "city": _case(_C, "'London'", "''", "'São Paulo'", "NULL", "'1'"), "state": _case(_C, "NULL", "'NY'", "''"),
        "zip": _case(_C, "'10001'", "'N10 1AA'", "''", "NULL", "'0000'"), "country_id": _case(_C, "1", "2245", "99", "2359", "NULL"),
        "country": _case(_C, "'France'", "'-'", "'123'", "NULL", "'http://x.y'"),
        "status": listed(_C, COMPANY_STATUS), "restriction": _case(_C, "'NO'", "'SOURCE WITH CARE'", "NULL", "'free'"),
        "headcount": f"CAST({_C} * 37 % 12000 AS INT)", "is_deleted": f"CAST({_C} % 3 AS INT)",
        "email_status": f"CAST({_C} % 3 AS INT)", "has_company": f"({_C} % 4 = 0)", "owner_id": "c_nationkey",
        "linked_id": f"(CASE WHEN {_C} % 6 = 0 THEN {_C} % 90 END)", "segment": "c_mktsegment", "balance": "CAST(round(c_acctbal) AS BIGINT)",
        "added_at": moment(_C), "modified_at": moment(f"{_C} + 7")}),
    "candidate_people": Fixture("supplier", {
        "id": "'s' || lpad(CAST(s_suppkey AS STRING), 6, '0')", "first_name": "'First' || CAST(s_suppkey AS STRING)", "last_name": "s_name",
        "email": email("(s_suppkey * 11)"), "phone": phone("(s_suppkey * 9)"), "linkedin": linkedin("(s_suppkey * 8)"),
        "street": _case(_S, "'1 Main St'", "''", "NULL"), "city": "'City' || CAST(s_nationkey AS STRING)", "state": "'ST'",
        "country": _case(_S, "'US'", "''", "NULL"), "created_on": "'2020-01-01T00:00:00'", "updated_on": "'2021-01-01T00:00:00'",
        "created_by": "CAST(s_nationkey AS STRING)"}),
    "contact_people": Fixture("customer", {
        "id": "'c' || lpad(CAST(c_custkey AS STRING), 6, '0')", "first_name": "'First' || CAST(c_custkey AS STRING)", "last_name": "c_name",
        "email": email(_C), "phone": phone(_C), "linkedin": linkedin(_C), "street": _case(_C, "'2 Side St'", "''", "NULL"),
        "city": "'City' || CAST(c_nationkey AS STRING)", "state": "'ST'", "country": "''", "created_on": "'2020-02-01T00:00:00'",
        "updated_on": "'2021-02-01T00:00:00'", "created_by": "CAST(c_nationkey AS STRING)"}),
    "people_rows": Fixture("supplier", {
        "id": _S, "first_name": "'First' || CAST(s_suppkey AS STRING)", "last_name": "s_name", "added_at": moment(_S),
        "modified_at": moment("s_suppkey + 2"), "address1": _case(_S, "'1 Main St.'", "''", "NULL"),
        "address2": _case(_S, "NULL", "'Flat #2'", "''", "'B'"), "city": "'City-' || CAST(s_nationkey AS STRING)",
        "state": _case(_S, "'NY'", "NULL"), "zip": _case(_S, "'10-001'", "''", "NULL"), "country": _case(_S, "'France'", "NULL"),
        "linked_id": "(CASE WHEN s_suppkey % 6 = 0 THEN s_suppkey + 1 END)"}),
    # projects and candidacies
    "postings": Fixture("orders", {
        "id": _O, "linked_id": "(CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey + 1 END)", "title": "'Role ' || CAST(o_orderkey % 50 AS STRING)",
        "employment_type": "o_orderpriority", "salary": "CAST(round(o_totalprice) AS BIGINT)", "public_description": html(_O),
        "description": html("(o_orderkey + 1)"), "owner_id": "o_custkey % 25", "company_id": "o_custkey",
        "status": listed(_O, PROJECT_STATUS), "added_at": "o_orderdate",
        "closed_at": "(CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END)", "address1": _case(_O, "'10 High St.'", "'7'", "NULL"),
        "address2": _case(_O, "'Flat #2'", "''"), "city": _case(_O, "'London'", "''", "'1'"), "state": _case(_O, "NULL", "'NY'", "''"),
        "zip": _case(_O, "'10001'", "'N10'", "''"), "job_number": "o_orderkey % 1000", "contact_id": "o_custkey",
        "salary_from": "CAST(o_orderkey % 4 * 1000 AS BIGINT)", "salary_to": "CAST(o_orderkey % 3 * 5000 AS BIGINT)"}),
    "applications": Fixture("lineitem", {
        "id": "l_orderkey * 10000000 + l_partkey * 100 + l_linenumber", "project_id": "l_orderkey", "person_id": "l_suppkey",
        "owner_id": "l_suppkey % 25", "status": listed("(l_orderkey + l_linenumber)", RESPONSE_STATUS), "added_at": "l_shipdate",
        "flag": "l_returnflag", "line_status": "l_linestatus", "line": "l_linenumber"}),
    "history": Fixture("events", {
        "person_id": "CAST(floor(event_id / 30) AS BIGINT)", "project_id": "CAST(floor(event_id / 3) AS BIGINT)", "status": "event_type", "ts": "ts", "event_id": "event_id"}),
    "comments": Fixture("documents", {
        "id": "doc_id", "person_id": "CAST(floor(doc_id / 10) AS BIGINT)", "created_by_id": "doc_id % 30",
        "comments": "(CASE WHEN doc_id % 9 = 0 THEN NULL ELSE '<p>' || text || '</p>' END)",
        "action": _case("doc_id", "'Call'", "'Mail Merge'", "' interview '", "'Note'", "NULL"), "added_at": moment("doc_id"),
        "subject": "source", "body": "text"}),
    "stages": Fixture("events", {
        "id": "event_id", "project_id": "CAST(floor(event_id / 10) AS BIGINT)", "candidate_id": "CAST(floor(event_id / 100) AS BIGINT)",
        "hire": "(CASE WHEN event_id % 31 = 0 THEN ts END)", "offer": "(CASE WHEN event_id % 13 = 0 THEN ts END)",
        "interview2": "(CASE WHEN event_id % 7 = 0 THEN ts END)", "interview1": "(CASE WHEN event_id % 5 = 0 THEN ts END)",
        "sent": "(CASE WHEN event_id % 2 = 0 THEN ts END)", "added": "ts"}),
    "attribute_rows": Fixture("part", {
        "id": "p_partkey", "kind": "p_type", "brand": "p_brand", "words": "replace(p_name, ' ', ',')", "size": "p_size"}),
    "id_texts": Fixture("orders", {
        "id": _O, "us": ("date_format(o_orderdate, 'dd/MM/yyyy HH:mm:ss')", "strftime(o_orderdate, '%d/%m/%Y %H:%M:%S')"),
        "mixed": (
            "CASE o_orderkey % 5 WHEN 0 THEN date_format(o_orderdate, 'dd/MM/yyyy HH:mm:ss') WHEN 1 THEN "
            "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') WHEN 2 THEN date_format(o_orderdate, 'dd/MM/yyyy') "
            "WHEN 3 THEN 'soon' END",
            "CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') WHEN 1 THEN "
            "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y') "
            "WHEN 3 THEN 'soon' END"),
        "epoch": ("unix_seconds(CAST(o_orderdate AS TIMESTAMP)) + o_orderkey", "CAST(epoch(o_orderdate) AS BIGINT) + o_orderkey"),
        "year": "CAST(CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 1990 + o_orderkey % 30 END AS INT)",
        "month": "CAST(o_orderkey % 14 AS INT)", "current": _case(_O, "'true'", "'False'", "NULL"),
        "open_end": _case(_O, "'9999-12-31 00:00:00'", "'2020-05-06 01:02:03'", "NULL"), "ordered": "o_orderdate"}),
})
