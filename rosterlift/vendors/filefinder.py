"""FileFinder: one generic address table for mails, numbers and pages, activity logs with a context, code tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.codes import code_groups, code_map, first_pattern, headcount_range
from ..functions.contact import email_norm, is_personal_email, linkedin_norm, phone_norm, website_norm
from ..functions.dates import iso, older_than_months
from ..functions.ids import uuid_from
from ..functions.location import prefer_filled
from ..functions.money import currency_code, range_text, whole_part
from ..functions.predicates import is_note_worth_keeping, not_blank, similar_to
from ..functions.text import CRLF, clean_html, sections, strip_tags
from ..operators.dedupe import filled_first, keep_first, on_first_holder_only, priority
from ..operators.joins import drop_orphans, fk_map, lookup_by_text, one_per_key, with_constant
from ..operators.reshape import union_all, unpivot
from ..plans.companies import build_company_relationships, build_contacts_from_projects
from ..plans.fees import build_fee_types
from ..plans.identities import CLASS_TYPES
from ..sources.sinks import Outputs

Read = Callable[[str], DataFrame]

# What the vendor's texts mean.
PROGRESS_TABLES = {"candidateprogress": "idcandidateprogress", "introductionprogress": "idintroductionprogress",
                   "assignmentsourceprogress": "idassignmentsourceprogress", "personreferenceprogress": "idpersonreferenceprogress"}
NOISE = ("Loaded via automatch into target list.", "List loaded into target list.", "Sending letter",
         "Addition to target list.", "Status changed in target list.", "Interview confirmation sent")
NOTE_TYPES = ("FreeEntry", "Email", "Letter", "Task", "Other", "SMS", "Fax")
MEETING_TYPES = ("Appointment", "PhoneCall")
WORK_MAIL = ("Work", "Company", "Business")
HOME_PHONE = ("Home", "Direct Line", "Private", "Home 2")
PROJECT_STATES = {
    "closed": ["assign complete - placed by us", "assign complete - cancelled", "rejected lob-in", "never start",
               "assign complete - no placement", "assign complete - internal placement", "pitch complete - lost",
               "pitch complete - cancelled", "finished"],
    "on_hold": ["assign - on hold"], "active": ["assign - active"], "lead": ["prospect", "pitch - active"],
}
CLOSE_REASONS = {
    "won": ["assign complete - placed by us", "finished", "assign complete - no placement", "assign complete - internal placement"],
    "cancelled": ["assign complete - cancelled", "pitch complete - cancelled", "never start"],
    "worked_lost": ["rejected lob-in"], "lead_lost": ["pitch complete - lost"],
}
CONTRACT_TYPES = [("%contract%", "contract"), ("%interim%", "contract"), ("%temp%", "contract")]
CANDIDATE_STATUS = {
    "Presented": ["longlist", "shortlist", "longlist reject", "shortlist reject", "longlist withdrew", "shortlist withdrew"],
    "Client IV": ["client interview", "client interview reject", "client interview withdrew"],
    "Internal IV": ["internal interview", "interviewed by cons", "internal interview reject", "internal interview withdrew"],
    "Offer": ["offer", "offer accept", "offer reject", "offer withdrew"], "Hired": ["placed"],
}
REJECTION_TYPES = {
    "self": ["turned down approach", "candidate withdrew", "offer reject", "client interview withdrew",
             "internal interview withdrew", "shortlist withdrew", "longlist withdrew", "offer withdrew"],
    "by_us": ["rejected by consult.", "internal interview reject"],
    "by_client": ["rejected by client", "client interview reject", "longlist reject", "shortlist reject"],
}
REJECTION_REASONS = {
    "not_qualified": ["rejected by consult.", "rejected by client", "client interview reject", "longlist reject",
                      "shortlist reject", "internal interview reject"],
    "other": ["turned down approach"],
    "accepted_another_offer": ["candidate withdrew", "offer reject", "client interview withdrew", "internal interview withdrew",
                               "shortlist withdrew", "longlist withdrew", "offer withdrew"],
}
EARLIEST = "2000-01-01"


def _ts(name: str) -> Column:
    return F.col(name).try_cast("timestamp")


def _stamps(created: str = "createdon", modified: str = "modifiedon") -> list[Column]:
    return [iso(_ts(created), "zulu").alias("created_at"), iso(_ts(modified), "zulu").alias("updated_at")]


def _by_name(rows: DataFrame, key: str, users: DataFrame, name: str, ctx: RunContext) -> DataFrame:
    """Add the id and atlas id of the user whose name stands in ``key``."""
    found = lookup_by_text(rows, key, users, "name", {f"{name}_id": "id", f"_{name}": "atlas_id"})
    return found.withColumn(f"{name}_atlas_id", F.coalesce(f"_{name}", ctx.master())).drop(f"_{name}")


def users(read: Read, ctx: RunContext, prior: DataFrame | None) -> DataFrame:
    staff = read("user").where(F.col("useremail").ilike(f"%@{ctx.domain}")).select(
        F.col("iduser").alias("id"), ctx.record_id("iduser").alias("atlas_id"), *_stamps(), F.col("useremail").alias("email"),
        F.col("fullname").alias("name"), F.lit("disabled").alias("status"), F.lower("useremail").alias("_mail"))
    rows = keep_first(staff, ["_mail"], [F.col("created_at").asc_nulls_last(), F.col("id").asc()])
    if prior is None:
        return rows.drop("_mail")
    known = one_per_key(prior.where("email IS NOT NULL"), [F.lower("email").alias("k")], F.min(F.struct("atlas_id", "name", "status")).alias("p"))
    rows = fk_map(rows, "_mail", known, "p", "_p", "k")
    return rows.select("id", *[F.coalesce(F.col(f"_p.{c}"), F.col(c)).alias(c) for c in ("atlas_id", "name", "status")], "email", "created_at", "updated_at")


def _addresses(read: Read, links: str, owner: str, type_table: str, type_key: str, best: Sequence[str], skip: str | None) -> DataFrame:
    """(owner, address struct): the filled address of the best type. Lines count only up to the first blank one."""
    rows = fk_map(read(links), "idpaddress", read("paddress").select(
        "idpaddress", F.struct("addressline1", "addressline2", "addressline3", "addressline4", "city", "countystate", "postcode", "idcountry").alias("a")),
        "a", "_a", "idpaddress", policy="exclude")
    rows = fk_map(rows, "_a.idcountry", read("country"), "value", "_country", "idcountry")
    rows = fk_map(rows, type_key, read(type_table), "value", "_type", type_key)
    lines = [prefer_filled(F.col(f"_a.addressline{i}")) for i in range(1, 5)]
    shown, so_far = [], F.lit(True)
    for line in lines:
        so_far = so_far & line.isNotNull()
        shown.append(F.when(so_far, line))
    filled = F.coalesce(*lines, *[F.nullif(F.col(c), F.lit("")) for c in ("_a.city", "_a.countystate", "_a.postcode", "_country")]).isNotNull()
    rows = rows.where(filled & (F.lower("_type") != skip)) if skip else rows.where(filled)
    rows = keep_first(rows, [owner], [priority(F.lower("_type"), best), F.col("idpaddress").asc()])
    return rows.select(F.col(owner).alias("k"), F.struct(
        F.concat_ws(", ", *shown).alias("location_street_address"), F.col("_a.city").alias("location_locality"),
        F.col("_a.countystate").alias("location_region"), F.col("_a.postcode").alias("location_postal_code"),
        F.col("_country").alias("location_country")).alias("v"))


_PLACE = ("location_street_address", "location_locality", "location_region", "location_postal_code", "location_country")


def people(read: Read, users: DataFrame, ctx: RunContext) -> DataFrame:
    place = _addresses(read, "person_paddress", "idperson", "personaddresstype", "idpersonaddresstype", ("private", "second home"), "business")
    rows = fk_map(read("person").where("isdeleted != 1"), "idperson", place, "v", "_v", "k")
    rows = fk_map(rows, "iduser", users, "atlas_id", "created_by_atlas_id", default=ctx.master())
    overview = sections([(f"Biography: {CRLF}", "biography"), (f"Person Comment: {CRLF}", "personcomment")], CRLF + CRLF)
    return rows.select(
        F.col("idperson").alias("id"), ctx.record_id("idperson").alias("atlas_id"), F.col("firstname").alias("first_name"),
        F.col("middlename").alias("middle_name"), F.col("lastname").alias("last_name"), *_stamps(), F.lit("active").alias("responsiveness"),
        F.lit("regular").alias("candidate_status"), overview.alias("overview"), *[F.col(f"_v.{c}").alias(c) for c in _PLACE],
        ctx.agency().alias("agency_id"), F.col("iduser").alias("created_by_id"), F.col("iduser").alias("updated_by_id"), "created_by_atlas_id",
        F.col("created_by_atlas_id").alias("updated_by_atlas_id"))


def companies(read: Read, users: DataFrame, ctx: RunContext) -> DataFrame:
    place = _addresses(read, "company_paddress", "idcompany", "companyaddresstype", "idcompanyaddresstype", ("postal address", "invoice"), None)
    rows = keep_first(read("company").where("isdeleted != 1"), ["idcompany"], [_ts("createdon").asc_nulls_last()])
    rows = fk_map(rows, "idcompany", place, "v", "_v", "k")
    rows = fk_map(rows, "iduser", users, "atlas_id", "atlas_owner_id", default=ctx.master())
    return rows.select(
        F.col("idcompany").alias("id"), ctx.record_id("idcompany").alias("atlas_id"), F.col("companyname").alias("name"),
        F.col("companycomment").alias("summary"), F.col("clientrelationshipnotes").alias("overview"), F.lit("none").alias("relationship"),
        headcount_range("noofemployees").alias("size"), *_stamps(), F.lit("migration").alias("source"), *[F.col(f"_v.{c}").alias(c) for c in _PLACE],
        F.col("iduser").alias("owner_id"), "atlas_owner_id", ctx.agency().alias("agency_id"))


def _contact_details(read: Read, links: str, link_id: str, owner: str) -> DataFrame:
    """Linked addresses, each read as the one kind its value looks like."""
    rows = fk_map(read(links), "ideaddress", read("eaddress"), "commvalue", "_raw", "ideaddress", policy="exclude")
    raw, low = F.col("_raw"), F.lower("_raw")
    mail = raw.like("%@%.%")
    page = low.rlike(r"^http|^www\.|\.com|\.in")
    number = (F.length(raw) > 7) & similar_to(raw, "%[0-9]{3}%") & ~raw.rlike(r"www\.|http|\.com")
    kind = (F.when(mail, "email").when(low.contains("linkedin.com"), "linkedin").when(page, "website").when(number, "phone"))
    typed = rows.withColumns({"_kind": kind, "_owner": F.col(owner), "_link": F.col(link_id)})
    value = (F.when(F.col("_kind") == "email", email_norm("_raw")).when(F.col("_kind") == "linkedin", linkedin_norm("_raw"))
             .when(F.col("_kind") == "website", website_norm("_raw")).when(F.col("_kind") == "phone", phone_norm("_raw")))
    extra = [c for c in ("idpersoncommunicationtype", "isdefault") if c in rows.columns]
    return unpivot(typed, ["_owner", "_link", "_raw", "rowtimestamp", *extra], [{"type": F.col("_kind"), "value": value}])


def person_identities(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    rows = _contact_details(read, "person_eaddress", "idperson_eaddress", "idperson")
    known = people.select("id", F.struct("atlas_id", "created_by_id", "created_by_atlas_id").alias("p"))
    rows = fk_map(rows, "_owner", known, "p", "_p", policy="exclude")
    rows = fk_map(rows, "idpersoncommunicationtype", read("personcommunicationtype"), "value", "_label", "idpersoncommunicationtype")
    mail, phone = F.col("type") == "email", F.col("type") == "phone"
    home = F.coalesce(F.col("_label").isin(*HOME_PHONE), F.lit(False))
    work = F.coalesce(F.col("_label").isin(*WORK_MAIL), F.lit(False))
    private = (mail & ~work & is_personal_email("_raw")) | (phone & home)
    rows = rows.withColumn("identity_type_type", F.when(private, "personal").otherwise("corporate"))
    rows = keep_first(rows, ["type", "value"], [filled_first("identity_type_type"), _ts("rowtimestamp").asc_nulls_last(), F.col("_link").asc()])
    at = iso(_ts("rowtimestamp"), "zulu")
    yes, no = F.lit(True), F.lit(False)
    return rows.select(
        ctx.record_id("_link").alias("atlas_id"), F.col("_owner").alias("person_id"), F.col("_p.atlas_id").alias("atlas_person_id"), "type", "value",
        "identity_type_type", code_map("type", {**CLASS_TYPES, "website": "SocialPersonIdentity"}).alias("class_type"), at.alias("created_at"),
        at.alias("updated_at"), F.lit("migration").alias("source"), no.alias("hidden"), no.alias("bounced"), yes.alias("active"), yes.alias("verified"),
        F.when(mail, F.coalesce("isdefault", no)).otherwise(phone & home).alias("favourite"), F.col("_p.created_by_id").alias("created_by_id"),
        F.col("_p.created_by_atlas_id").alias("created_by_atlas_id"), ctx.agency().alias("agency_id"))


def company_identities(read: Read, companies: DataFrame, ctx: RunContext) -> DataFrame:
    rows = _contact_details(read, "company_eaddress", "idcompany_eaddress", "idcompany").where("type != 'email'")
    rows = fk_map(rows, "_owner", companies, "atlas_id", "atlas_company_id", policy="exclude")
    rows = keep_first(rows, ["type", "value"], [_ts("rowtimestamp").asc_nulls_last(), F.col("_link").asc()])
    at = iso(_ts("rowtimestamp"), "zulu")
    return rows.select(ctx.record_id("_link").alias("atlas_id"), F.col("_owner").alias("company_id"), "atlas_company_id", "type", "value",
                       at.alias("created_at"), at.alias("updated_at"), F.lit("migration").alias("source"), ctx.agency().alias("agency_id"),
                       (F.col("type") == "website").alias("is_primary"))


def _logs(read: Read, kinds: Sequence[str], contexts: Sequence[str], owner: str, ctx: RunContext) -> DataFrame:
    """Activity-log entries worth keeping as sectioned text, once per entity they concern."""
    codes = union_all(*[read(table).select(F.col(key).alias("id"), "value") for table, key in PROGRESS_TABLES.items()])
    progress = one_per_key(codes, [F.col("id").alias("k")], F.min("value").alias("v"))
    logs = read("activitylog").where(F.col("activitytype").isin(*kinds) & is_note_worth_keeping("subject", "description", NOISE, 30, 10))
    logs = fk_map(logs, "progressid", progress, "v", "_progress", "k")
    text = sections([("Progress: ", "_progress"), ("Subject: ", "subject"), ("Description: ", "description")])
    logs = logs.select("idactivitylog", F.struct(strip_tags(text, " ").alias("text"), "activitytype", "createdby").alias("l"))
    entries = read("activitylogentity").where(F.col("contextentitytype").isin(*contexts))
    rows = fk_map(entries, "idactivitylog", logs, "l", "_l", "idactivitylog", policy="exclude")
    rows = keep_first(rows, ["idactivitylogentity"], [F.col(owner).asc()])
    created = F.coalesce(_ts("createdon"), ctx.now())
    return rows.select(
        F.col("idactivitylogentity").cast("string").alias("id"), F.col(owner).alias("_owner"), F.col("_l.text").alias("text"),
        F.col("_l.activitytype").alias("action"), F.col("_l.createdby").alias("createdby"), iso(created, "zulu").alias("created_at"),
        iso(F.coalesce(_ts("modifiedon"), created), "zulu").alias("updated_at"))


def company_notes(read: Read, companies: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    rows = _logs(read, (*NOTE_TYPES, *MEETING_TYPES), ("Company",), "contextentityid", ctx)
    rows = _by_name(fk_map(rows, "_owner", companies, "atlas_id", "atlas_company_id", policy="exclude"), "createdby", users, "created_by", ctx)
    return rows.select("id", ctx.record_id("id").alias("atlas_id"), F.col("_owner").alias("company_id"), "atlas_company_id", "text",
                       F.lit("manual").alias("type"), "created_at", "updated_at", "created_by_id", "created_by_atlas_id")


def person_notes(read: Read, people: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    """The note on a person's own record, and the log entries that are no meetings."""
    held = fk_map(read("person").where(not_blank("note")), "iduser", users, "name", "createdby")
    own = held.select(F.concat(F.col("idperson").cast("string"), F.lit("person_note")).alias("id"), F.col("idperson").alias("_owner"),
                      strip_tags("note", " ").alias("text"), "createdby", *_stamps())
    rows = union_all(own, _logs(read, NOTE_TYPES, ("Assignment", "Person"), "idperson", ctx).drop("action"))
    rows = _by_name(fk_map(rows, "_owner", people, "atlas_id", "atlas_person_id", policy="exclude"), "createdby", users, "created_by", ctx)
    return rows.select("id", ctx.record_id("id").alias("atlas_id"), F.col("_owner").alias("person_id"), "atlas_person_id", "text",
                       F.lit("manual").alias("type"), "created_at", "updated_at", "created_by_id", "created_by_atlas_id")


def meetings(read: Read, people: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    rows = _logs(read, MEETING_TYPES, ("Assignment", "Person"), "idperson", ctx)
    rows = _by_name(fk_map(rows, "_owner", people, "atlas_id", "atlas_person_id", policy="exclude"), "createdby", users, "created_by", ctx)
    return rows.select("id", ctx.record_id("id").alias("atlas_id"), F.col("_owner").alias("person_id"), "atlas_person_id", "created_by_id",
                       "created_by_atlas_id", "action", F.col("text").alias("notes"), F.lit("migrated meeting").alias("name"), "created_at",
                       "updated_at", F.lit("completed").alias("status"))


def person_salaries(read: Read, people: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    amounts = ("salary", "bonus", "package")
    any_pay = F.lit(False)
    for c in amounts:
        any_pay = any_pay | (F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) != 0)
    job = read("company_person").select("idcompany_person", F.struct("idperson", "createdon", "modifiedon").alias("j"))
    rows = fk_map(read("remuneration").where(any_pay), "idcompany_person", job, "j", "_j", "idcompany_person", policy="exclude")
    rows = fk_map(rows, "_j.idperson", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = fk_map(rows, "idcurrency", read("currency"), "value", "_currency", "idcurrency")
    rows = _by_name(rows, "createdby", users, "created_by", ctx)
    return rows.select(
        F.concat(F.lit("ACTUAL-"), F.col("idremuneration").cast("string")).alias("id"), ctx.record_id(F.lit("ACTUAL-"), "idremuneration").alias("atlas_id"),
        F.col("_j.idperson").alias("person_id"), "atlas_person_id", *_stamps("_j.createdon", "_j.modifiedon"),
        iso(_ts("_j.createdon"), "date").alias("relevant_date"), whole_part("salary").alias("basic_salary"), whole_part("bonus").alias("bonus_salary"),
        whole_part("package").alias("total_salary"), currency_code("_currency").alias("currency"), F.col("packagenote").alias("notes"),
        F.lit("gross").alias("tax_method"), F.lit("total").alias("expected_salary_type"), F.lit("migration").alias("source"), F.lit("actual").alias("type"),
        "created_by_id", "created_by_atlas_id", ctx.agency().alias("agency_id"))


def educations(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(read("education").where(F.col("educationestablishment") != ""), "idperson", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = keep_first(rows, ["ideducation"], [_ts("createdon").desc_nulls_last()])
    rows = fk_map(rows, "idqualification", read("qualification"), "value", "_degree", "idqualification")
    return rows.select(
        F.col("ideducation").alias("id"), ctx.record_id("ideducation").alias("atlas_id"), F.col("idperson").alias("person_id"), "atlas_person_id",
        F.col("educationsubject").alias("field_of_study"), F.col("_degree").alias("degree"), F.col("educationestablishment").alias("name"),
        F.col("notes").alias("description"), iso(_ts("educationfrom"), "date").alias("started_at"), iso(_ts("educationto"), "date").alias("finished_at"),
        *_stamps(), F.lit("migration").alias("source"), ctx.agency().alias("agency_id"))


def experiences(read: Read, people: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(read("company_person").where(F.col("jobtitle") != ""), "idperson", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = keep_first(rows, ["idcompany_person"], [_ts("createdon").desc_nulls_last()])
    rows = fk_map(rows, "idcompany", companies, "atlas_id", "atlas_company_id")
    body = strip_tags("note", " ")
    return rows.select(
        F.col("idcompany_person").alias("id"), ctx.record_id("idcompany_person").alias("atlas_id"), F.col("idperson").alias("person_id"), "atlas_person_id",
        F.col("idcompany").alias("company_id"), "atlas_company_id", F.col("jobtitle").alias("title"), F.col("companynameonly").alias("company_name"),
        F.coalesce(iso(_ts("employmentfrom"), "date"), F.lit(EARLIEST)).alias("started_at"), iso(_ts("employmentto"), "date").alias("finished_at"),
        F.when(F.trim(body) != "", body).alias("description"), F.lit("migration").alias("source"), *_stamps(), ctx.agency().alias("agency_id"))


def projects(read: Read, companies: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    """Assignments, closed after six months. A repeated assignment number stays on the oldest one."""
    rows = read("assignment").where("isdeleted != 1")
    for key, table, name in (("idassignmentstatus", "assignmentstatus", "_status"), ("idassignmenttype", "assignmenttype", "_type")):
        rows = fk_map(rows, key, read(table), "value", name, key)
    rows = fk_map(rows.where(F.lower("_status") != "research/reference"), "idcompany", companies, "atlas_id", "atlas_company_id", policy="exclude")
    rows = fk_map(rows, "idcurrency1", read("currency"), "value", "salary_currency", "idcurrency")
    known = users.select("id", F.struct("id", "atlas_id").alias("u"))
    rows = fk_map(rows, "iduser", known, "u", "_u")
    stale = F.coalesce(older_than_months(_ts("createdon"), ctx.today), F.lit(False))
    state = F.when(stale, "closed").otherwise(code_groups("_status", PROJECT_STATES, "active"))
    reason = F.coalesce(code_groups("_status", CLOSE_REASONS), F.when(state == "closed", "worked_lost"))
    out = rows.select(
        F.col("idassignment").alias("id"), ctx.record_id("idassignment").alias("atlas_id"), F.col("idcompany").alias("company_id"), "atlas_company_id", *_stamps(),
        F.col("assignmenttitle").alias("job_role"), clean_html("assignmentbrief").alias("description"), clean_html("assignmentcomment").alias("notes"),
        first_pattern("_type", CONTRACT_TYPES, "full_time").alias("contract_type"), state.alias("state"), reason.alias("close_reason"),
        F.when(state == "closed", iso(F.coalesce(_ts("actualcompletedate"), ctx.now()), "zulu")).alias("closed_at"),
        range_text("salaryfrom", "salaryto").alias("salary"), "salary_currency", F.col("_u.id").alias("owner_id"),
        F.coalesce("_u.atlas_id", ctx.master()).alias("atlas_owner_id"), F.col("assignmentno").alias("job_number"), F.lit("project").alias("class_type"),
        ctx.agency().alias("agency_id"))
    return on_first_holder_only(out, "job_number", [F.col("created_at").asc_nulls_last(), F.col("id").asc()], ["id"])


def project_company_contacts(read: Read, projects: DataFrame, contacts: DataFrame) -> DataFrame:
    held = contacts.select(F.col("person_id").alias("k"), F.struct("id", "atlas_id").alias("c"))
    rows = fk_map(read("assignmentcontact"), "idassignment", projects, "atlas_id", "atlas_project_id", policy="exclude")
    rows = fk_map(rows, "idperson", held, "c", "_c", "k", policy="exclude")
    return rows.select(F.col("idassignment").alias("project_id"), "atlas_project_id", *_stamps(), F.col("idperson").alias("person_id"),
                       F.col("_c.id").alias("company_contact_id"), F.col("_c.atlas_id").alias("atlas_company_contact_id"))


def candidates(read: Read, projects: DataFrame, people: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    """Candidates of an assignment and its sources, the newest row per project and person."""
    listed = fk_map(read("assignmentcandidate").where("isexcluded != 1"), "idcandidateprogress", read("candidateprogress"), "value", "_code", "idcandidateprogress")
    kind = code_groups("_code", REJECTION_TYPES)
    day = F.concat(F.col("contactedon").try_cast("date").cast("string"), F.lit("T00:00:00Z"))
    status = code_groups("_code", CANDIDATE_STATUS, "Added")
    listed = listed.select(
        F.col("idassignmentcandidate").alias("id"), ctx.record_id("idassignmentcandidate").alias("atlas_id"), "idassignment", "idperson", "createdon", "modifiedon",
        "createdby", "contactedby", status.alias("status"), kind.alias("rejection_type"), code_groups("_code", REJECTION_REASONS).alias("rejection_reason"),
        F.when(kind.isNotNull(), day).alias("rejected_at"), F.when(status == "Hired", day).alias("hired_at"))
    sources = read("assignmentsource").select(
        F.col("idassignmentsource").alias("id"), ctx.record_id(F.lit("SRC-"), "idassignmentsource").alias("atlas_id"), "idassignment", "idperson", "createdon",
        F.col("createdon").alias("modifiedon"), "createdby", F.lit("Added").alias("status"))
    rows = union_all(listed, sources)
    rows = fk_map(rows, "idassignment", projects, "atlas_id", "atlas_project_id", policy="exclude")
    rows = fk_map(rows, "idperson", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = keep_first(rows, ["idassignment", "idperson"], [_ts("createdon").desc_nulls_last(), F.col("atlas_id").asc()])
    rows = _by_name(_by_name(rows, "contactedby", users, "contact", ctx), "createdby", users, "owner", ctx)
    refused = F.col("rejection_type").isNotNull()
    return rows.select(
        "id", "atlas_id", *_stamps(), F.col("idassignment").alias("project_id"), "atlas_project_id", F.col("idperson").alias("person_id"), "atlas_person_id",
        F.lit("Candidate").alias("class_type"), "status", "rejection_type", "rejection_reason", "rejected_at", "hired_at",
        F.when(refused, F.col("contact_id")).alias("rejected_by_id"), F.when(refused, F.col("contact_atlas_id")).alias("atlas_rejected_by_id"), "owner_id",
        F.col("owner_atlas_id").alias("atlas_owner_id"), ctx.agency().alias("agency_id"))


def project_fees(read: Read, projects: DataFrame, fee_types: DataFrame, ctx: RunContext) -> DataFrame:
    """Final or estimated fees of assignments that carry one."""
    some = (F.coalesce("baseestimatedfee", F.lit(0)) != 0) | (F.coalesce("finalfee", F.lit(0)) != 0)
    rows = fk_map(read("assignment").where(some), "idassignment", projects, "atlas_id", "atlas_project_id", policy="exclude")
    rows = fk_map(rows, "idcurrency", read("currency"), "value", "_currency", "idcurrency")
    rows = with_constant(rows, fee_types.select(F.col("atlas_id").alias("fee_type_id")))
    shown = F.trim(F.coalesce(F.col("estimatedfee").cast("string"), F.col("finalfee").cast("string"), F.col("feecomment").cast("string")))
    key = F.concat(shown, F.lit("_projected_"), F.col("idassignment").cast("string"))
    amount = F.trim(F.coalesce(F.col("finalfee").cast("string"), F.col("estimatedfee").cast("string")))
    currency, now = F.coalesce(F.trim("_currency"), F.lit("USD")), iso(ctx.now(), "zulu")
    note = F.when(not_blank("feecomment"), F.concat(F.lit("Migrated Fee: "), F.trim("feecomment"))).otherwise("Migrated Fee")
    return rows.select(
        key.alias("id"), uuid_from(ctx.client, key).alias("atlas_id"), F.col("idassignment").alias("project_id"), "atlas_project_id", now.alias("created_at"),
        now.alias("updated_at"), ctx.master().alias("created_by_id"), ctx.master().alias("created_by_atlas_id"), ctx.agency().alias("agency_id"), "fee_type_id",
        now.alias("fee_date"), amount.alias("amount"), currency.alias("currency"), F.lit("paid").alias("project_fee_status"), note.alias("notes"),
        amount.alias("default_amount"), currency.alias("agency_currency"))


def files(read: Read, owners: DataFrame, entity: str) -> DataFrame:
    """Documents filed under a record, stored in folders by the first two letters of their name."""
    named = read("document").where(not_blank("newdocumentname") & not_blank("originaldocumentname") & F.col("newdocumentname").contains("."))
    held = named.select("iddocument", F.struct("newdocumentname", "originaldocumentname", "description").alias("d"))
    rows = fk_map(read("entitydocument"), "iddocument", held, "d", "_d", "iddocument", policy="exclude")
    rows = fk_map(rows, "entityid", owners, "atlas_id", f"atlas_{entity}_id", policy="exclude")
    name = F.col("_d.newdocumentname")
    said = F.lower(F.concat_ws(" ", "_d.originaldocumentname", "_d.description"))
    return rows.select(
        F.col("entityid").alias(f"{entity}_id"), f"atlas_{entity}_id", F.concat(F.upper(F.left(name, F.lit(2))), F.lit("/"), name).alias("file_name"),
        F.col("_d.originaldocumentname").alias("actual_file_name"), F.when(said.rlike("resume|cv|profile"), "resume").otherwise("other").alias("type"))


def tables(read: Read, ctx: RunContext, out: Outputs, prior_users: DataFrame | None = None) -> None:
    staff = out.add("users", users(read, ctx, prior_users))
    ours, firms = out.add("people", people(read, staff, ctx)), out.add("companies", companies(read, staff, ctx))
    jobs = out.add("projects", projects(read, firms, staff, ctx))
    owners = read("assignment").select("idassignment", "idcompany")
    links = fk_map(read("assignmentcontact"), "idassignment", owners, "idcompany", "company_id", "idassignment", policy="exclude")
    positions = read("company_person").select(F.col("idperson").alias("person_id"), F.col("idcompany").alias("company_id"), F.col("jobtitle").alias("title"),
                                              F.col("isactiveemployment").alias("is_active"))
    links = drop_orphans(links.withColumn("person_id", F.col("idperson")), "person_id", read("person"), "idperson")
    contacts = out.add("company_contacts", build_contacts_from_projects(links, positions, firms, ours, ctx))
    out.add("person_identities", person_identities(read, ours, ctx))
    out.add("company_identities", company_identities(read, firms, ctx))
    out.add("company_notes", company_notes(read, firms, staff, ctx))
    out.add("person_notes", person_notes(read, ours, staff, ctx))
    out.add("meetings", meetings(read, ours, staff, ctx))
    out.add("person_salaries", person_salaries(read, ours, staff, ctx))
    out.add("educations", educations(read, ours, ctx))
    out.add("experiences", experiences(read, ours, firms, ctx))
    out.add("project_company_contacts", project_company_contacts(read, jobs, contacts))
    fee_types = out.add("fee_types", build_fee_types(jobs.sparkSession, ctx))
    out.add("project_fees", project_fees(read, jobs, fee_types, ctx))
    out.add("candidates", candidates(read, jobs, ours, staff, ctx))
    parents = read("company").select(F.col("idcompany").alias("id"), F.col("parentid").alias("parent_id"), _ts("createdon").alias("added_at"),
                                     _ts("modifiedon").alias("modified_at"), F.col("createdby").alias("created_by"))
    out.add("company_relationships", build_company_relationships(parents, firms, ctx, staff))
    out.add("file_person_mapping", files(read, ours, "person"))
    out.add("company_map_files", files(read, firms, "company").drop("type"))
