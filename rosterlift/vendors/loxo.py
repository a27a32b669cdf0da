"""Loxo: nested records flattened to child tables with a root id, activities for notes, meetings and candidacies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.codes import code_map, first_pattern
from ..functions.contact import email_norm, is_personal_email, linkedin_norm, phone_kind, phone_norm, website_norm
from ..functions.dates import iso, year_month_end, year_month_start
from ..functions.ids import uuid_from
from ..functions.location import location_locality
from ..functions.money import plain_amount
from ..functions.names import degree_part, field_of_study_part, file_kind
from ..functions.predicates import has_file_type, in_filter, not_blank
from ..functions.text import scrub, strip_tags
from ..operators.dedupe import filled_first, keep_first
from ..operators.history import outcome
from ..operators.joins import drop_orphans, fk_map, one_per_key
from ..operators.reshape import union_all, unpivot
from ..plans.identities import CLASS_TYPES, identity_cell
from ..plans.notes import build_form_notes
from ..sources.sinks import Outputs

Read = Callable[[str], DataFrame]

# What the vendor's activity types mean.
ACTIVITY_STATUS = {
    "Sourced & Messaged on LinkedIn": "Added", "Spoken to / In-progress": "Added",
    "Sourced & Messaged on LinkedIn / Unsourced": "Added", "Marked as Yes": "Added", "Sourced": "Added",
    "Scorecard Submitted": "Added", "Moved to Applied": "Added", "Moved to Rejected": "Added",
    "Interview": "Client IV", "Moved to Interview": "Client IV", "Submitted": "Client IV",
    "Moved to To submit": "Presented", "Moved to Rejected after Submitted / Interviewed": "Presented",
    "Rejected": "Presented", "Moved to Submitted": "Presented", "Offer": "Offer", "Moved to Offer": "Offer",
    "Moved to Last follow up": "Internal IV", "Moved to Still chasing": "Internal IV",
    "Moved to Spoken to / In-progress": "Internal IV", "Moved to Sourced": "Internal IV",
    "Rejected / By Candidate": "Internal IV", "Moved to Hired": "Hired", "Hired": "Hired",
}
ACTIVITY_REJECTION = {"Rejected / By Candidate": "self", "Moved to Rejected after Submitted / Interviewed": "by_client",
                      "Rejected": "by_us", "Moved to Rejected": "by_us"}
CONTRACT_TYPES = [("%full time%", "full_time"), ("%contract%", "contract"), ("%part time%", "part_time")]
DOCUMENTS = ("pdf", "docx", "doc")
MISSING_TITLE = "Title Missing"


def _ts(name: str) -> Column:
    return F.col(name).try_cast("timestamp")


def _stamps() -> list[Column]:
    return [iso(_ts("created")).alias("created_at"), iso(_ts("updated")).alias("updated_at")]


def _now(ctx: RunContext) -> list[Column]:
    return [F.lit(ctx.now_iso).alias("created_at"), F.lit(ctx.now_iso).alias("updated_at")]


def people(read: Read, ctx: RunContext) -> DataFrame:
    name = F.col("name")
    none = F.lit(None).cast("string")
    return read("people").select(
        "id", ctx.record_id("id").alias("atlas_id"), F.split_part(name, F.lit(" "), F.lit(1)).alias("first_name"),
        F.when(name.contains(" "), F.substring(name, F.instr(name, " ") + F.lit(1), F.length(name))).alias("last_name"),
        F.col("desc").alias("overview"), *_stamps(), F.lit("active").alias("responsiveness"),
        F.lit("regular").alias("candidate_status"), scrub("city").alias("location_locality"),
        scrub("state").alias("location_region"), scrub("zip").alias("location_postal_code"),
        scrub("country").alias("location_country"), none.alias("created_by_id"), none.alias("updated_by_id"),
        ctx.master().alias("created_by_atlas_id"), ctx.master().alias("updated_by_atlas_id"), ctx.agency().alias("agency_id"))


def person_identities(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    """Mails, numbers, profiles and web pages; the person imported first keeps a shared value."""
    none, no = F.lit(None).cast("string"), F.lit(False)
    mail, link, site, number = email_norm("email"), linkedin_norm("value"), website_norm("value"), phone_norm("phone")
    private, label = is_personal_email(mail), phone_kind(F.lower(F.trim("type")))
    rows = union_all(
        unpivot(read("people_emails"), ["root_id"], [identity_cell(
            "email", F.when(mail.like("%@%.%"), mail), F.when(private, "personal").otherwise("corporate"), private)]),
        unpivot(read("people_phones"), ["root_id"], [
            identity_cell("phone", F.when(F.length(number) > 3, number), label, label == "personal")]),
        unpivot(read("people_social"), ["root_id"], [
            identity_cell("linkedin", F.when(link.contains("linkedin.com"), link), none, no),
            identity_cell("website", F.when(site.contains(".") & ~site.contains("linkedin.com"), site), none, no)]))
    known = people.select("id", F.struct("atlas_id", "created_at", "updated_at").alias("p"))
    rows = fk_map(rows, "root_id", known, "p", "_p", policy="exclude")
    rows = keep_first(rows, ["type", "value"], [F.col("_p.created_at").asc_nulls_last(), F.col("root_id").asc()])
    return rows.select(
        uuid_from(ctx.client, "_p.atlas_id", "type", "value").alias("atlas_id"), F.col("_p.atlas_id").alias("atlas_person_id"),
        F.col("root_id").alias("person_id"), "type", "value", "identity_type_type",
        code_map("type", {**CLASS_TYPES, "website": "SocialPersonIdentity"}).alias("class_type"),
        ctx.agency().alias("agency_id"), ctx.master().alias("created_by_id"), F.lit("migration").alias("source"),
        no.alias("hidden"), no.alias("bounced"), F.lit(True).alias("active"), "favourite", F.lit(True).alias("verified"),
        F.col("_p.created_at").alias("created_at"), F.col("_p.updated_at").alias("updated_at"))


def companies(read: Read, ctx: RunContext) -> DataFrame:
    """Companies not hidden, with their first type and address."""
    rows = read("companies").where(F.col("hidden").isNull() | (F.lower("hidden") != "true"))
    kind = one_per_key(read("companies_types").where("row_index = 1"), [F.col("root_id")], F.min("value").alias("kind"))
    place = one_per_key(read("companies_addresses"), [F.col("root_id")],
                        F.min(F.struct("city", "state", "zip", "country")).alias("place"))
    rows = fk_map(fk_map(rows, "id", kind, "kind", "_kind", "root_id"), "id", place, "place", "_place", "root_id")
    city, state, zip_, country = (scrub(F.col(f"_place.{c}")) for c in ("city", "state", "zip", "country"))
    return rows.select(
        ctx.record_id("id").alias("atlas_id"), "id", "name", strip_tags(F.coalesce("desc", "culture"), " ").alias("summary"),
        F.when(F.lower("_kind").contains("client"), "client").otherwise("none").alias("relationship"),
        city.alias("location_metro"), state.alias("location_region"), zip_.alias("location_postal_code"),
        country.alias("location_country"), location_locality(city, state, zip_, country).alias("location_locality"), *_stamps())


def company_identities(read: Read, companies: DataFrame, ctx: RunContext) -> DataFrame:
    link, site = linkedin_norm("url"), website_norm("url")
    rows = unpivot(read("companies").withColumn("company_id", F.col("id")), ["company_id"], [
        {"type": F.lit("website"), "value": F.when(site.contains(".") & ~site.contains("linkedin.com"), site)},
        {"type": F.lit("linkedin"), "value": F.when(link.contains("linkedin.com"), link)}])
    rows = fk_map(rows, "company_id", companies, "atlas_id", "atlas_company_id", policy="exclude")
    rows = keep_first(rows, ["type", "value"], [F.col("company_id").asc()])
    return rows.select(ctx.record_id("company_id", "type", "value").alias("atlas_id"), "company_id", "atlas_company_id", "type",
                       "value", (F.col("type") == "website").alias("is_primary"), *_now(ctx))


def company_contacts(read: Read, people: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    """Contacts at the companies they work for now, one row per person and company."""
    kinds = one_per_key(read("people_types").where("value = 'Contact'"), [F.col("root_id")])
    held = read("people_experience").where("current = 'true'").select("root_id", "companyid", F.nullif(F.trim("title"), F.lit("")).alias("title"))
    rows = drop_orphans(held, "root_id", kinds, "root_id")
    rows = fk_map(rows, "root_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = fk_map(rows, "companyid", companies, "atlas_id", "atlas_company_id", policy="exclude")
    rows = keep_first(rows, ["root_id", "companyid"], [filled_first("title"), F.col("title").asc()])
    key = F.concat(F.col("root_id").cast("string"), F.lit("contact"), F.col("companyid").cast("string"))
    return rows.select(
        key.alias("id"), uuid_from(ctx.client, key).alias("atlas_id"), F.col("root_id").alias("person_id"), "atlas_person_id",
        F.col("companyid").cast("string").alias("company_id"), "atlas_company_id", ctx.agency().alias("agency_id"),
        F.coalesce("title", F.lit(MISSING_TITLE)).alias("title"), F.lit("client").alias("relationship"), *_now(ctx))


def experiences(read: Read, people: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    rows = read("people_experience").where(not_blank("title"))
    rows = fk_map(rows, "root_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = keep_first(rows, ["row_uid"], [F.col("root_id").asc(), F.col("title").asc()])
    rows = fk_map(rows, "companyid", companies, "atlas_id", "atlas_company_id")
    return rows.select(
        F.col("row_uid").alias("id"), ctx.record_id("row_uid").alias("atlas_id"), *_now(ctx), F.lit("migration").alias("source"),
        ctx.agency().alias("agency_id"), year_month_start("from_year", "from_month", F.lit(ctx.today)).alias("started_at"),
        year_month_end("to_year", "to_month", "current").alias("finished_at"), F.nullif(F.trim("company"), F.lit("")).alias("company_name"),
        F.trim("title").alias("title"), strip_tags("desc", " ").alias("description"), F.col("root_id").alias("person_id"),
        "atlas_person_id", F.col("companyid").cast("string").alias("company_id"), "atlas_company_id")


def educations(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(read("people_education").where(not_blank("school")), "root_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = keep_first(rows, ["row_uid"], [F.col("root_id").asc(), F.col("school").asc()])
    return rows.select(
        F.col("row_uid").alias("id"), ctx.record_id("row_uid").alias("atlas_id"), *_now(ctx), F.lit("migration").alias("source"),
        ctx.agency().alias("agency_id"), F.lit(None).cast("string").alias("started_at"),
        year_month_end("year", "month", F.lit("false")).alias("finished_at"), F.trim("school").alias("name"),
        degree_part("degree").alias("degree"), field_of_study_part("degree").alias("field_of_study"),
        strip_tags("desc", " ").alias("description"), F.col("root_id").alias("person_id"), "atlas_person_id")


def projects(read: Read, companies: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(read("jobs"), "company", companies, "atlas_id", "atlas_company_id")
    status = F.lower("status")
    closed = F.coalesce(status == "inactive", F.lit(False))
    place = [scrub(c) for c in ("address", "city", "state", "zip", "country")]
    names = ("location_street_address", "location_metro", "location_region", "location_postal_code", "location_country")
    return rows.select(
        "id", ctx.record_id("id").alias("atlas_id"), F.col("title").alias("job_role"),
        strip_tags("desc", " ").alias("job_description"), strip_tags("notes", " ").alias("notes"),
        F.col("company").alias("company_id"), "atlas_company_id", *_stamps(),
        F.when(closed, iso(_ts("updated"))).alias("closed_at"),
        F.when(closed, "closed").when(status == "hold", "on_hold").otherwise("active").alias("state"),
        F.when(closed, "won").alias("close_reason"), first_pattern("type", CONTRACT_TYPES, "full_time").alias("contract_type"),
        location_locality(*place).alias("location_locality"), *[p.alias(n) for p, n in zip(place, names)],
        F.col("id").alias("job_number"), F.lit(None).cast("string").alias("owner_id"), ctx.master().alias("atlas_owner_id"),
        ctx.agency().alias("agency_id"), F.lit("project").alias("class_type"))


def project_company_contacts(read: Read, projects: DataFrame, people: DataFrame, contacts: DataFrame) -> DataFrame:
    """A project's contact person with one contact row: the one at the project's company, else the person's first."""
    known = projects.select("id", F.struct("atlas_id", F.col("company_id").cast("string").alias("company")).alias("p"))
    rows = fk_map(read("jobs_contacts").select("root_id", F.col("value").alias("person_id")), "root_id", known, "p", "_p", policy="exclude")
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    first = one_per_key(contacts, [F.col("person_id").alias("pid")], F.min("id").alias("first"))
    rows = fk_map(rows, "person_id", first, "first", "_first", "pid", policy="exclude")
    at_company = F.concat(F.col("person_id").cast("string"), F.lit("contact"), F.col("_p.company"))
    rows = fk_map(rows, at_company, contacts, "atlas_id", "_here")
    rows = fk_map(rows, "_first", contacts, "atlas_id", "_any")
    return rows.select(F.col("root_id").alias("project_id"), F.col("_p.atlas_id").alias("atlas_project_id"), "person_id",
                       "atlas_person_id", F.coalesce("_here", "_any").alias("atlas_company_contact_id"))


def candidates(read: Read, projects: DataFrame, people: DataFrame, ctx: RunContext) -> DataFrame:
    """The latest configured activity per project and person tells the stage."""
    rows = read("activities").where(in_filter("type", ctx.filters.get("candidates")))
    rows = fk_map(rows, "job", projects, "atlas_id", "atlas_project_id", policy="exclude")
    rows = fk_map(rows, "person", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = keep_first(rows, ["job", "person"], [_ts("updated").desc_nulls_last(), _ts("created").desc_nulls_last(), F.col("id").desc()])
    changed = iso(_ts("updated"))
    marks = outcome(F.col("type"), ACTIVITY_STATUS, ACTIVITY_REJECTION, {}, changed)
    return rows.select(
        "id", ctx.record_id("person", F.lit("-"), "job").alias("atlas_id"), *_stamps(), F.col("job").alias("project_id"),
        "atlas_project_id", F.col("person").alias("person_id"), "atlas_person_id", F.lit(None).cast("string").alias("owner_id"),
        ctx.master().alias("atlas_owner_id"), F.lit("Candidate").alias("class_type"), *[c.alias(n) for n, c in marks.items()],
        F.when(marks["rejection_type"].isNotNull(), ctx.master()).alias("atlas_rejected_by_id"),
        F.when(marks["status"] == "Hired", changed).alias("hired_at"))


def _activities(read: Read, people: DataFrame, ctx: RunContext, kind: str) -> DataFrame:
    rows = read("activities").where(not_blank("notes") & in_filter("type", ctx.filters.get(kind)))
    return fk_map(rows, "person", people, "atlas_id", "atlas_person_id", policy="exclude")


def person_notes(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    """Activity notes, and one note per filled form."""
    written = _activities(read, people, ctx, "notes").select(
        F.col("id").cast("string").alias("id"), uuid_from(ctx.client, "id", "person").alias("atlas_id"),
        F.col("person").alias("person_id"), "atlas_person_id", F.lit(None).cast("string").alias("created_by_id"),
        ctx.master().alias("created_by_atlas_id"), strip_tags("notes", " ").alias("text"), *_stamps(), F.lit("manual").alias("type"))
    forms = read("forms").select(F.col("id").alias("form_id"), F.col("personid").alias("person_id"), "title")
    answers = read("forms_answers").select(F.col("root_id").alias("form_id"), "question", F.col("text").alias("answer"))
    filled = build_form_notes(answers.join(forms, "form_id"), people, ctx)
    return union_all(written, filled)


def meetings(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    return _activities(read, people, ctx, "meetings").select(
        "id", uuid_from(ctx.client, "id", "person").alias("atlas_id"), F.col("person").alias("person_id"), "atlas_person_id",
        F.lit(None).cast("string").alias("created_by_id"), ctx.master().alias("created_by_atlas_id"),
        strip_tags("notes", " ").alias("notes"), F.lit("completed").alias("status"), F.lit("migrated meeting").alias("name"), *_stamps())


def person_salaries(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(read("people").where(not_blank("comp_comp")), "id", people, "atlas_id", "atlas_person_id", policy="exclude")
    return rows.select(
        "id", uuid_from(ctx.client, F.lit("salary"), "id").alias("atlas_id"), F.col("id").alias("person_id"), "atlas_person_id",
        *_stamps(), iso(_ts("updated")).alias("relevant_date"), plain_amount("comp_comp").alias("basic_salary"),
        F.nullif(F.btrim(strip_tags("comp_notes", " ")), F.lit("")).alias("notes"), F.lit("USD").alias("currency"),
        F.lit("gross").alias("tax_method"), F.lit("total").alias("expected_salary_type"), F.lit("migration").alias("source"),
        F.lit("actual").alias("type"), F.lit(None).cast("string").alias("created_by_id"), ctx.master().alias("created_by_atlas_id"), ctx.agency().alias("agency_id"))


def files(read: Read, people: DataFrame) -> DataFrame:
    """Resumes, documents of a person and documents of a person's activities."""
    def listed(rows: DataFrame, key: str, folder: str, kind: Column) -> DataFrame:
        kept = rows.where((F.col("path") != "") & has_file_type("filename", DOCUMENTS))
        return fk_map(kept, key, people, "atlas_id", "atlas_person_id", policy="exclude").select(
            F.col(key).alias("person_id"), "atlas_person_id", F.concat(F.lit(folder), "path").alias("file_name"),
            F.col("filename").alias("actual_file_name"), kind.alias("type"))

    attached = fk_map(read("activities_documents"), "root_id", read("activities"), "person", "person", policy="exclude")
    return union_all(listed(read("people_resumes"), "root_id", "", F.lit("resume")),
                     listed(attached, "person", "people/", file_kind("filename")),
                     listed(read("people_documents"), "root_id", "", file_kind("filename")))


def tables(read: Read, ctx: RunContext, out: Outputs) -> None:
    ours, firms = out.add("people", people(read, ctx)), out.add("companies", companies(read, ctx))
    jobs = out.add("projects", projects(read, firms, ctx))
    contacts = out.add("company_contacts", company_contacts(read, ours, firms, ctx))
    out.add("person_identities", person_identities(read, ours, ctx))
    out.add("company_identities", company_identities(read, firms, ctx))
    out.add("experiences", experiences(read, ours, firms, ctx))
    out.add("educations", educations(read, ours, ctx))
    out.add("project_company_contacts", project_company_contacts(read, jobs, ours, contacts))
    out.add("candidates", candidates(read, jobs, ours, ctx))
    out.add("person_notes", person_notes(read, ours, ctx))
    out.add("meetings", meetings(read, ours, ctx))
    out.add("person_salaries", person_salaries(read, ours, ctx))
    out.add("file_person_mapping", files(read, ours))
    papers = fk_map(read("companies_documents").where(F.col("path") != ""), "root_id", firms, "atlas_id", "atlas_company_id", policy="exclude")
    out.add("company_map_files", papers.select(F.col("root_id").alias("company_id"), "atlas_company_id",
                                               F.col("path").alias("file_name"), F.col("filename").alias("actual_file_name")))
