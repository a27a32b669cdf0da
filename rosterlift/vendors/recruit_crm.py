"""Recruit CRM: candidates and contacts in two lists, epoch timestamps, careers in numbered shards, hotlists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.codes import code_map, headcount_range
from ..functions.contact import email_norm, github_norm, linkedin_norm, phone_norm
from ..functions.dates import epoch_midnight
from ..functions.ids import uuid_from
from ..functions.location import prefer_filled
from ..functions.predicates import not_blank
from ..functions.text import clean_html
from ..operators.dedupe import column_maxima, keep_first
from ..operators.joins import fk_map, lookup_by_text, match_any_key, one_per_key
from ..operators.numbering import number_within
from ..operators.reshape import union_all, unpivot
from ..plans.identities import CLASS_TYPES
from ..plans.people import build_people_from_two_lists
from ..sources.sinks import Outputs
from ..sources.tables import SourceMap, read_shards

Read = Callable[[str], DataFrame]

_PERSON = {"first_name": "first_name", "last_name": "last_name", "email": "email", "phone": "contact_number",
           "linkedin": "profile_linkedin", "city": "city", "state": "state",
           "created_on": "date_format(timestamp_seconds(try_cast(created_on AS bigint)), \"yyyy-MM-dd'T00:00:00'\")",
           "updated_on": "date_format(timestamp_seconds(try_cast(updated_on AS bigint)), \"yyyy-MM-dd'T00:00:00'\")",
           "created_by": "CAST(created_by AS string)"}
CANDIDATES = SourceMap("candidate_data", {"id": "slug", **_PERSON, "street": "fulladdress", "country": "country"})
CONTACTS = SourceMap("contact_data", {"id": "slug", **_PERSON, "street": "full_address", "country": "''"})

# What the vendor's statuses and note types mean.
CANDIDATE_STATUS = {
    "Assigned": "Added", "Rejected": "Added", "Applied": "Added", "Long List/ Targets": "Added",
    "CV Sent": "Presented", "Shortlist": "Presented", "1st round Interview": "Client IV",
    "2nd Round Interview": "Client IV", "3rd Round Interview": "Client IV", "Final Interview": "Client IV",
    "Did Not Join": "Offer", "Placed": "Hired",
}
JOB_STATE = {"Filled": "closed", "Closed": "closed", "On Hold": "on_hold", "Lead/ Prospect": "lead"}
CLOSE_REASON = {"Filled": "won", "Closed": "worked_lost", "Lead/ Prospect": "lead_lost"}
HOTLIST_NAMES = {"candidates": "Candidate Hotlist", "contacts": "Contact Hotlist", "companies": "Company Hotlist"}
CALL_NOTE_TYPES = (58736, 60192)


def _id(ctx: RunContext, *parts: Column | str) -> Column:
    return uuid_from(ctx.client, *parts).alias("atlas_id")


def _days(created: str = "created_on", updated: str = "updated_on") -> list[Column]:
    return [epoch_midnight(created).alias("created_at"), epoch_midnight(updated).alias("updated_at")]


def person_identities(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    """Details of candidates and, after them, of contacts; a contact's go to the candidate it matches."""
    def cell(kind: str, value: Column, scope: str) -> dict[str, Column]:
        return {"type": F.lit(kind), "value": F.nullif(value, F.lit("")), "identity_type_type": F.lit(scope)}

    candidates, contacts = read("candidate_data"), read("contact_data")
    keys = [("email", email_norm("email"), email_norm("email")),
            ("phone", phone_norm("contact_number"), phone_norm("contact_number")),
            ("linkedin", linkedin_norm("profile_linkedin"), linkedin_norm("profile_linkedin"))]
    matched = match_any_key(contacts, "slug", candidates, "slug", keys)
    owned = contacts.join(matched, "slug", "left").withColumn(
        "person_id", F.coalesce("match_id", F.concat(F.lit("cc"), "slug")))
    first = unpivot(candidates.withColumn("person_id", F.col("slug")), ["person_id"], [
        cell("email", email_norm("email"), "personal"), cell("phone", phone_norm("contact_number"), "personal"),
        cell("linkedin", linkedin_norm("profile_linkedin"), "personal"),
        cell("github", github_norm("profile_github"), "personal")])
    second = unpivot(owned, ["person_id"], [
        cell("email", email_norm("email"), "corporate"), cell("phone", phone_norm("contact_number"), "corporate"),
        cell("phone", phone_norm("mobile_number"), "corporate"),
        cell("linkedin", linkedin_norm("profile_linkedin"), "personal")])
    rows = union_all(first.withColumn("_order", F.lit(1)), second.withColumn("_order", F.lit(2)))
    rows = keep_first(rows.withColumn("_value", F.lower("value")), ["_value"],
                      [F.col("_order").asc(), F.col("person_id").asc(), F.col("type").asc(), F.col("value").asc()])
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id")
    return rows.select(
        _id(ctx, "value"), "value", F.lit(True).alias("favourite"), F.lit(True).alias("active"), "type",
        "identity_type_type", code_map("type", CLASS_TYPES).alias("class_type"), "person_id", "atlas_person_id",
        F.lit(ctx.midnight_iso).alias("created_at"), F.lit(ctx.midnight_iso).alias("updated_at"),
        F.lit("migration").alias("source"))


def companies(read: Read, ctx: RunContext) -> DataFrame:
    return read("company_data").select(
        F.col("slug").alias("id"), _id(ctx, "slug"), F.col("company").alias("name"),
        F.lit("target").alias("relationship"), prefer_filled("full_address", "city").alias("location_locality"),
        F.col("city").alias("location_name"), F.col("company_state").alias("location_region"),
        F.col("city").alias("location_metro"), F.col("country").alias("location_country"),
        F.lit(None).cast("string").alias("summary"), *_days(),
        headcount_range(F.col("company_size").try_cast("int")).alias("size"))


def company_identities(read: Read, companies: DataFrame, ctx: RunContext) -> DataFrame:
    def bare(column: str) -> Column:
        return F.regexp_replace(F.regexp_replace(F.lower(column), r"^https?://(www\.)?|^www\.", ""), "/$", "")

    branches = [{"type": F.lit(kind), "value": F.when(not_blank(column), bare(column)), "is_primary": F.lit(first)}
                for kind, column, first in (("website", "website", True), ("linkedin", "profile_linkedin", False))]
    raw = read("company_data").withColumn("company_id", F.col("slug"))
    rows = unpivot(raw, ["company_id", "created_on", "updated_on"], branches)
    rows = keep_first(rows, ["type", "value"], [F.col("created_on").asc_nulls_last(), F.col("company_id").asc()])
    rows = fk_map(rows, "company_id", companies, "atlas_id", "atlas_company_id")
    return rows.select(_id(ctx, "value"), "company_id", "atlas_company_id", "type", "value", *_days(),
                       ctx.agency().alias("agency_id"), "is_primary")


def company_contacts(read: Read, people: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    by_contact = one_per_key(people, [F.coalesce("contact_id", "id").alias("id")], F.min("atlas_id").alias("atlas_id"))
    rows = fk_map(read("contact_data"), "slug", by_contact, "atlas_id", "atlas_person_id", policy="exclude")
    rows = fk_map(rows, "company_slug", companies, "atlas_id", "atlas_company_id", policy="exclude")
    rows = keep_first(rows, ["slug"], [F.col("updated_on").desc_nulls_last(), F.col("company_slug").asc()])
    return rows.select(
        F.col("slug").alias("id"), _id(ctx, "slug"), F.col("slug").alias("person_id"), "atlas_person_id",
        F.col("company_slug").alias("company_id"), "atlas_company_id", F.lit("prospect").alias("relationship"),
        F.coalesce("designation", F.lit("contact")).alias("title"), *_days())


def experiences(shards: DataFrame, people: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    """shards: the work history, united. One row per candidate, title and start."""
    rows = shards.where(not_blank("work_company_name") & F.col("title").isNotNull()
                        & F.col("work_start_date").isNotNull())
    rows = rows.withColumn("atlas_id", uuid_from(ctx.client, "candidate_slug", "title", "work_start_date"))
    rows = keep_first(rows, ["atlas_id"], [F.col("work_start_date").asc(), F.col("work_company_name").asc()])
    rows = fk_map(rows, "candidate_slug", people, "atlas_id", "atlas_person_id")
    rows = lookup_by_text(rows, "work_company_name", companies, "name",
                          {"company_id": "id", "atlas_company_id": "atlas_id", "_name": "name"})
    return rows.select(
        F.col("atlas_id").alias("id"), "atlas_id", F.col("candidate_slug").alias("person_id"), "atlas_person_id",
        "company_id", "atlas_company_id", F.left("work_start_date", F.lit(10)).alias("started_at"),
        F.left("work_end_date", F.lit(10)).alias("finished_at"), "title", "description",
        F.lit("migration").alias("source"), F.coalesce("_name", "work_company_name").alias("company_name"))


def educations(shards: DataFrame, people: DataFrame, ctx: RunContext) -> DataFrame:
    key = [F.coalesce(c, F.lit("1")) for c in ("candidate_slug", "institute_name", "educational_qualification")]
    rows = shards.where(not_blank("institute_name")).withColumn("atlas_id", ctx.record_id(*key))
    rows = keep_first(rows, ["atlas_id"], [F.col("education_start_date").asc_nulls_last(),
                                           F.col("educational_specialization").asc_nulls_last()])
    rows = fk_map(rows, "candidate_slug", people, "atlas_id", "atlas_person_id")
    return rows.select(
        F.col("atlas_id").alias("id"), "atlas_id", F.col("candidate_slug").alias("person_id"), "atlas_person_id",
        F.col("institute_name").alias("name"), F.col("educational_qualification").alias("degree"),
        F.col("educational_specialization").alias("field_of_study"),
        F.col("education_description").alias("description"), F.lit("migration").alias("source"),
        F.left("education_start_date", F.lit(10)).alias("started_at"),
        F.left("education_end_date", F.lit(10)).alias("finished_at"))


def projects(read: Read, companies: DataFrame, users: DataFrame, ctx: RunContext,
             leads_lost_before: str | None = None) -> DataFrame:
    """Jobs with their description and latest note. Leads opened before a given day can be closed as lost."""
    last = one_per_key(read("assignment_data"), [F.col("job_slug")],
                       epoch_midnight(F.max(F.col("stage_date").try_cast("bigint"))).alias("assigned_at"))
    texts = one_per_key(read("job_description_data"), [F.col("job_slug")], F.min("job_description").alias("text"))
    noted = one_per_key(read("note_data"), [F.col("related_to")],
                        F.max_by("note", F.struct("created_on", "note_id")).alias("note"))
    rows = read("job_data")
    for ref, value, key in ((last, "assigned_at", "job_slug"), (texts, "text", "job_slug"), (noted, "note", "related_to")):
        rows = fk_map(rows, "slug", ref, value, f"_{value}", key)
    rows = fk_map(rows, "company_slug", companies, "atlas_id", "atlas_company_id")
    for key, name in (("owner_id", "atlas_owner_id"), ("created_by", "created_by_id"), ("updated_by", "updated_by_id")):
        rows = fk_map(rows, key, users, "atlas_id", name, default=ctx.master())
    stale = F.lit(False)
    if leads_lost_before:
        stale = (F.col("job_status") == "Lead/ Prospect") & (epoch_midnight("created_on") < F.lit(leads_lost_before))
    state = F.when(stale, "closed").otherwise(code_map("job_status", JOB_STATE, "active"))
    closed_at = F.coalesce("_assigned_at", epoch_midnight("updated_on"))
    return rows.select(
        F.col("slug").alias("id"), _id(ctx, "slug"), F.col("name").alias("job_role"), *_days(),
        clean_html("_text").alias("description"), F.lit("full_time").alias("contract_type"),
        F.lit("project").alias("class_type"), F.lit("1").alias("hire_target"), "owner_id", "atlas_owner_id",
        state.alias("state"), F.when(state == "closed", closed_at).alias("closed_at"),
        F.when(state == "closed", code_map("job_status", CLOSE_REASON)).alias("close_reason"),
        F.col("company_slug").alias("company_id"), "atlas_company_id", F.lit(False).alias("public"),
        ctx.agency().alias("agency_id"), "created_by_id", "updated_by_id", clean_html("_note").alias("notes"),
        F.col("job_code").alias("job_number"))


def project_company_contacts(read: Read, people: DataFrame, contacts: DataFrame, projects: DataFrame) -> DataFrame:
    by_contact = one_per_key(people.where("contact_id IS NOT NULL"), [F.col("contact_id")],
                             F.min("atlas_id").alias("atlas_id"))
    held = one_per_key(contacts, [F.col("atlas_person_id")],
                       F.min(F.struct("id", F.col("atlas_id").alias("aid"))).alias("_cc"))
    rows = fk_map(read("job_data"), "contact_slug", by_contact, "atlas_id", "_person", "contact_id", policy="exclude")
    rows = fk_map(rows, "_person", held, "_cc", "_cc", "atlas_person_id", policy="exclude")
    rows = fk_map(rows, "slug", projects, "atlas_id", "atlas_project_id")
    return rows.select(F.col("slug").alias("project_id"), "atlas_project_id",
                       F.col("_cc.id").alias("company_contact_id"), F.col("_cc.aid").alias("atlas_company_contact_id"))


def candidates(read: Read, people: DataFrame, projects: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(read("assignment_data"), "candidate_slug", people, "atlas_id", "atlas_person_id")
    rows = fk_map(rows, "job_slug", projects, "atlas_id", "atlas_project_id")
    rows = fk_map(rows, "candidate_slug", read("candidate_data"), "owner_id", "owner_id", "slug")
    rows = fk_map(rows, "owner_id", users, "atlas_id", "atlas_owner_id", default=ctx.master())
    rows = rows.withColumn("atlas_id", uuid_from(ctx.client, "candidate_slug", "job_slug"))
    return rows.select(
        F.col("atlas_id").alias("id"), "atlas_id", F.col("candidate_slug").alias("person_id"), "atlas_person_id",
        F.col("job_slug").alias("project_id"), "atlas_project_id", F.lit("Candidate").alias("class_type"),
        code_map("candidate_status", CANDIDATE_STATUS).alias("status"), "owner_id", "atlas_owner_id", *_days())


def _note_type() -> Column:
    return F.when(F.col("note_type_id").isin(*CALL_NOTE_TYPES), "phone_call").otherwise("manual")


def _noted_by(rows: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(rows, "created_by_id", users, "atlas_id", "created_by_atlas_id", default=ctx.master())
    return fk_map(rows, "updated_by_id", users, "atlas_id", "updated_by_atlas_id", default=ctx.master())


def person_notes(read: Read, people: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    """Call logs and notes on a person, one row per note id."""
    key = F.coalesce("contact_id", "candidate_id")
    by_key = one_per_key(people.where(key.isNotNull()), [key.alias("id")], F.min("atlas_id").alias("atlas_id"))
    person = F.coalesce("related_candidate", "related_contact").cast("string")
    authors = [F.col("created_by").alias("created_by_id"), F.col("updated_by").alias("updated_by_id")]
    calls = read("call_log_data").where(F.col("call_notes").isNotNull() & person.isNotNull()).select(
        F.concat(F.lit("call_log_"), person, F.lit("_"), F.md5("call_notes")).alias("id"), person.alias("person_id"),
        F.col("call_notes").alias("note"), *authors, *_days(), F.lit("phone_call").alias("type"))
    written = read("note_data").where("note IS NOT NULL AND related_to IS NOT NULL").select(
        F.col("note_id").cast("string").alias("id"), F.col("related_to").cast("string").alias("person_id"), "note",
        *authors, *_days(), _note_type().alias("type"))
    rows = fk_map(union_all(calls, written), "person_id", by_key, "atlas_id", "atlas_person_id", policy="exclude")
    rows = column_maxima(_noted_by(rows, users, ctx), ["id"])
    return rows.withColumns({"atlas_id": uuid_from(ctx.client, "id"), "text": clean_html("note"),
                             "agency_id": ctx.agency()}).drop("note")


def company_notes(read: Read, companies: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(read("note_data"), "related_to", companies, "atlas_id", "atlas_company_id", policy="exclude")
    rows = rows.withColumns({"created_by_id": F.col("created_by"), "updated_by_id": F.col("updated_by")})
    return _noted_by(rows, users, ctx).select(
        F.col("note_id").alias("id"), _id(ctx, "note_id"), clean_html("note").alias("text"), *_days(), "created_by_id",
        "updated_by_id", "created_by_atlas_id", "updated_by_atlas_id", _note_type().alias("type"),
        F.col("related_to").alias("company_id"), "atlas_company_id")


def custom_attributes(read: Read, ctx: RunContext) -> DataFrame:
    """One attribute per kind of hotlist."""
    return read("hotlist_data").select(F.col("entity_name").alias("alias")).distinct().select(
        _id(ctx, F.lit("hotlist"), "alias", F.lit(ctx.agency_id)), code_map("alias", HOTLIST_NAMES, "hotlist").alias("name"),
        "alias", F.lit(ctx.midnight_iso).alias("created_at"), F.lit(ctx.midnight_iso).alias("updated_at"),
        ctx.agency().alias("agency_id"), F.lit(True).alias("multiple_values"),
        F.when(F.col("alias") == "companies", "company").otherwise("person").alias("of"), F.lit(False).alias("ai"))


def custom_attribute_options(read: Read, attributes: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(read("hotlist_data"), "entity_name", attributes, "atlas_id", "atlas_attribute_id", "alias",
                  policy="exclude")
    rows = rows.select(F.col("hotlist_id").alias("id"), _id(ctx, "hotlist_id"), "atlas_attribute_id",
                       F.col("name").alias("value"))
    numbered = number_within(rows, ["atlas_attribute_id"], ["value", "id"])
    return numbered.withColumns({"created_at": F.lit(ctx.midnight_iso), "updated_at": F.lit(ctx.midnight_iso),
                                 "agency_id": ctx.agency()})


def hotlist_values(links: DataFrame, link_key: str, owners: DataFrame, owner_key: str, options: DataFrame, entity: str,
                   ctx: RunContext) -> DataFrame:
    """links: a record's slug and hotlist id. The record's membership as an attribute value."""
    choice = options.select(F.col("id").alias("hotlist_id"), F.struct("atlas_attribute_id", "atlas_id").alias("_o"))
    rows = fk_map(links, "hotlist_id", choice, "_o", "_o", "hotlist_id", policy="exclude")
    held = owners.where(F.col(owner_key).isNotNull()).select(
        F.col(owner_key).alias("_key"), F.struct("id", "atlas_id").alias("_p"))
    rows = rows.join(held, F.col(link_key) == F.col("_key"))
    return rows.select(
        _id(ctx, "_p.id", "_o.atlas_attribute_id", "_o.atlas_id"), F.col("_p.id").alias(f"{entity}_id"),
        F.col("_p.atlas_id").alias(f"atlas_{entity}_id"),
        F.col("_o.atlas_attribute_id").alias("atlas_custom_attribute_id"), F.col("_o.atlas_id").alias("atlas_option_id"),
        F.lit(ctx.midnight_iso).alias("created_at"), F.lit(ctx.midnight_iso).alias("updated_at"))


# What a history without any table looks like.
WORK_HISTORY = ("candidate_slug string, work_start_date string, work_end_date string, title string, description string, "
                "work_company_name string")
EDUCATION_HISTORY = ("candidate_slug string, institute_name string, educational_qualification string, "
                     "educational_specialization string, education_description string, education_start_date string, "
                     "education_end_date string")


def tables(read: Read, ctx: RunContext, out: Outputs, users: DataFrame, work_history: DataFrame | None = None,
           education_history: DataFrame | None = None, leads_lost_before: str | None = None) -> None:
    """``users``: the user mapping seed. The two histories are found by themselves where ``read`` is a ``TableReader``: all
    their numbered shards, or the one table. Any other ``read`` needs them given.
    """
    if work_history is None:
        work_history = read_shards(read, "work_history_{}_data", "work_history_data", WORK_HISTORY)
    if education_history is None:
        education_history = read_shards(read, "education_history_{}_data", "education_history_data", EDUCATION_HISTORY)
    people = out.add("people", build_people_from_two_lists(CANDIDATES.read(read), CONTACTS.read(read), ctx))
    firms = out.add("companies", companies(read, ctx))
    jobs = out.add("projects", projects(read, firms, users, ctx, leads_lost_before))
    contacts = out.add("company_contacts", company_contacts(read, people, firms, ctx))
    attributes = out.add("custom_attributes", custom_attributes(read, ctx))
    options = out.add("custom_attribute_options", custom_attribute_options(read, attributes, ctx))
    memberships = {"person": [("candidate_hotlist_data", "candidate_slug", people, "candidate_id"),
                              ("contact_hotlist_data", "contact_slug", people, "contact_id")],
                   "company": [("company_hotlist_data", "company_slug", firms, "id")]}
    for entity, parts in memberships.items():
        out.add(f"{entity}_custom_attribute_values", union_all(*[
            hotlist_values(read(t), key, owners, o, options, entity, ctx) for t, key, owners, o in parts]))
    out.add("person_identities", person_identities(read, people, ctx))
    out.add("company_identities", company_identities(read, firms, ctx))
    out.add("experiences", experiences(work_history, people, firms, ctx))
    out.add("educations", educations(education_history, people, ctx))
    out.add("project_company_contacts", project_company_contacts(read, people, contacts, jobs))
    out.add("candidates", candidates(read, people, jobs, users, ctx))
    out.add("person_notes", person_notes(read, people, users, ctx))
    out.add("company_notes", company_notes(read, firms, users, ctx))
