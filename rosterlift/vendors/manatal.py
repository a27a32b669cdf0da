"""Manatal: candidates with a list of profiles, contacts matched to them by profile address."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.codes import code_map, stage_from_dates
from ..functions.dates import iso
from ..functions.ids import uuid_from
from ..functions.names import first_name, last_name
from ..functions.predicates import not_blank
from ..operators.dedupe import keep_first
from ..operators.joins import exclude, fk_map, lookup_by_text, match_any_key, one_per_key
from ..operators.reshape import union_all, unpivot
from ..plans.identities import CLASS_TYPES
from ..sources.sinks import Outputs

Read = Callable[[str], DataFrame]

# Job states, and the steps of a match, furthest first.
JOB_STATE = {"lost": "closed", "won": "closed", "on_hold": "on_hold"}
CLOSE_REASON = {"won": "won", "lost": "worked_lost"}
STEPS = [("Hired", "hired_at"), ("Offer", "offer_at"), ("Client IV", "interview_at"), ("Presented", "submitted_at")]


def _id(ctx: RunContext, *parts: Column | str) -> Column:
    return uuid_from(ctx.client, *parts).alias("atlas_id")


def _days() -> list[Column]:
    return [iso(F.col(c).try_cast("timestamp"), "midnight").alias(c) for c in ("created_at", "updated_at")]


def _filled(column: str) -> Column:
    return F.nullif(F.trim(F.col(column).cast("string")), F.lit(""))


def matches(read: Read) -> tuple[DataFrame, DataFrame]:
    """(contact, its candidate) and (candidate, its contact): the smallest id that shares a profile address."""
    profile, own = F.rtrim("social_media_url", F.lit("/")), F.rtrim("linkedin_url", F.lit("/"))
    contacts, social = read("contact"), read("candidate_social")
    to_candidate = match_any_key(contacts, "id", social, "candidate_id", [("profile", own, profile)])
    to_contact = match_any_key(social, "candidate_id", contacts, "id", [("profile", profile, own)])
    return to_candidate, to_contact


def people(read: Read, users: DataFrame, ctx: RunContext) -> DataFrame:
    """Candidates, then the contacts no candidate shares a profile with."""
    to_candidate, to_contact = matches(read)
    rows = fk_map(read("candidate"), "id", to_contact, "match_id", "contact_id", "candidate_id")
    rows = fk_map(rows, "creator_id", users, "atlas_id", "_creator")
    author = F.coalesce("_creator", uuid_from(ctx.client, "creator_id"))
    ours = rows.select(
        F.col("id").cast("string").alias("id"), F.col("id").alias("candidate_id"), "contact_id", first_name("full_name").alias("first_name"),
        last_name("full_name").alias("last_name"), _id(ctx, "id"), *_days(), F.col("creator_id").cast("string").alias("created_by_id"),
        author.alias("created_by_atlas_id"), F.lit("").alias("_place"), "city", "country")
    key = F.concat(F.lit("cc"), F.col("id").cast("string"))
    theirs = exclude(read("contact"), "id", to_candidate).select(
        key.alias("id"), F.col("id").alias("contact_id"), first_name("full_name").alias("first_name"),
        last_name("full_name").alias("last_name"), _id(ctx, key), *_days(), ctx.master().alias("created_by_id"),
        uuid_from(ctx.client, F.lit(ctx.master_id)).alias("created_by_atlas_id"), F.col("location").alias("_place"),
        F.lit("").alias("city"), F.lit("").alias("country"))
    rows = union_all(ours, theirs)
    place = F.trim(F.concat(F.coalesce("city", F.lit("")), F.lit(" "), F.coalesce("country", F.lit(""))))
    return rows.select(
        "id", "candidate_id", "contact_id", "first_name", "last_name", "atlas_id", "created_at", "updated_at", "created_by_id",
        "created_by_atlas_id", F.col("created_by_id").alias("updated_by_id"), F.col("created_by_atlas_id").alias("updated_by_atlas_id"),
        F.lit("active").alias("responsiveness"), F.lit("regular").alias("candidate_status"), ctx.agency().alias("agency_id"),
        F.when(F.coalesce("_place", F.lit("")) == "", place).otherwise(F.col("_place")).alias("location_locality"),
        F.col("city").alias("location_metro"), F.col("country").alias("location_country"))


def person_identities(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    """Details of candidates first, then of contacts; those of a matched contact go to its candidate."""
    def cell(kind: str, column: str, scope: str) -> dict[str, Column]:
        return {"type": F.lit(kind), "value": F.when(not_blank(column), F.col(column)), "identity_type_type": F.lit(scope)}

    to_candidate, _ = matches(read)
    own = F.col("id").cast("string")
    candidates = read("candidate").withColumn("person_id", own)
    social = fk_map(read("candidate_social"), "candidate_id", read("candidate").select("id", own.alias("p")), "p", "person_id", policy="exclude")
    contacts = fk_map(read("contact"), "id", to_candidate, "match_id", "_match")
    alone = F.concat(F.lit("cc"), own)
    contacts = contacts.withColumn("person_id", F.coalesce(F.col("_match").cast("string"), alone))
    profile = cell("linkedin", "linkedin_url", "personal")
    profile["value"] = F.when(F.col("_match").isNull(), profile["value"])
    first = union_all(unpivot(candidates, ["person_id"], [cell("email", "email", "personal"), cell("phone", "phone_number", "personal")]),
                      unpivot(social, ["person_id"], [cell("linkedin", "social_media_url", "personal")]))
    second = unpivot(contacts, ["person_id"], [cell("email", "email", "corporate"), cell("phone", "phone_number", "corporate"), profile])
    rows = union_all(first.withColumn("_order", F.lit(1)), second.withColumn("_order", F.lit(2)))
    rows = rows.withColumn("_value", F.lower(F.trim("value")))
    rows = keep_first(rows, ["_value"], [F.col("_order").asc(), F.col("person_id").asc(), F.col("type").asc(), F.col("value").asc()])
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id")
    day = F.lit(ctx.midnight_iso)
    return rows.select(_id(ctx, "value"), "value", F.lit(True).alias("favourite"), F.lit(True).alias("active"), "type", "identity_type_type",
                       code_map("type", CLASS_TYPES).alias("class_type"), "person_id", "atlas_person_id", day.alias("created_at"),
                       day.alias("updated_at"), F.lit("migration").alias("source"))


def companies(read: Read, users: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(read("organization"), "creator_id", users, "atlas_id", "created_by_atlas_id",
                  default=uuid_from(ctx.client, F.lit(ctx.master_id)))
    return rows.select("id", _id(ctx, "id"), "name", F.lit("client").alias("relationship"), F.col("location").alias("location_locality"),
                       F.col("description").alias("summary"), *_days(), F.col("creator_id").alias("created_by_id"), "created_by_atlas_id")


def company_identities(read: Read, companies: DataFrame, ctx: RunContext) -> DataFrame:
    bare = F.regexp_replace(F.regexp_replace(F.lower("website"), r"^https?://(www\.)?|^www\.", ""), "/$", "")
    raw = read("organization").withColumn("company_id", F.col("id"))
    rows = unpivot(raw, ["company_id", "created_at", "updated_at"], [{"type": F.lit("website"), "value": F.when(not_blank("website"), bare)}])
    rows = keep_first(rows, ["value"], [F.col("created_at").asc_nulls_last(), F.col("company_id").asc()])
    rows = fk_map(rows, "company_id", companies, "atlas_id", "atlas_company_id")
    return rows.select(_id(ctx, "value"), "company_id", "atlas_company_id", "type", "value", *_days(), ctx.agency().alias("agency_id"),
                       F.lit(True).alias("is_primary"))


def company_contacts(read: Read, people: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    by_contact = one_per_key(people.where("contact_id IS NOT NULL"), [F.col("contact_id").alias("cid")], F.min(F.struct("id", "atlas_id")).alias("p"))
    rows = fk_map(read("contact"), "id", by_contact, "p", "_p", "cid", policy="exclude")
    rows = fk_map(rows, "organization_id", companies, "atlas_id", "atlas_company_id", policy="exclude")
    return rows.select("id", _id(ctx, "id"), F.col("_p.id").alias("person_id"), F.col("_p.atlas_id").alias("atlas_person_id"),
                       F.col("organization_id").alias("company_id"), "atlas_company_id", F.lit("prospect").alias("relationship"),
                       F.lit("contact").alias("title"), *_days())


def person_notes(read: Read, people: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    def side(table: str, key: str, prefix: str) -> DataFrame:
        owner = one_per_key(people.where(F.col(key).isNotNull()), [F.col(key).alias("k")], F.min(F.struct("id", "atlas_id")).alias("p"))
        rows = fk_map(read(table).where(not_blank("info")), key, owner, "p", "_p", "k", policy="exclude")
        return rows.select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("id"), F.col("info").alias("text"), *_days(),
                           F.col("creator_id").alias("created_by_id"), F.col("_p.id").alias("person_id"), F.col("_p.atlas_id").alias("atlas_person_id"))

    rows = union_all(side("candidate_note", "candidate_id", "cn"), side("contact_note", "contact_id", "ctn"))
    rows = fk_map(rows, "created_by_id", users, "atlas_id", "created_by_atlas_id", default=uuid_from(ctx.client, F.lit(ctx.master_id)))
    return rows.withColumns({"atlas_id": uuid_from(ctx.client, "id"), "updated_by_id": F.col("created_by_id"),
                             "updated_by_atlas_id": F.col("created_by_atlas_id"), "type": F.lit("manual")})


def _of_candidates(rows: DataFrame, people: DataFrame, policy: str = "exclude") -> DataFrame:
    known = people.where("candidate_id IS NOT NULL").select("candidate_id", F.struct("id", "atlas_id").alias("p"))
    return fk_map(rows, "candidate_id", known, "p", "_p", "candidate_id", policy=policy)


def experiences(read: Read, people: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    rows = read("candidate_experience").where(not_blank("started_at") & F.col("position_name").isNotNull() & not_blank("employer_name"))
    rows = keep_first(_of_candidates(rows, people), ["id"], [F.col("started_at").asc(), F.col("candidate_id").asc()])
    rows = lookup_by_text(rows, "employer_name", companies, "name", {"company_id": "id", "atlas_company_id": "atlas_id", "_name": "name"})
    return rows.select("id", _id(ctx, "id"), F.col("_p.id").alias("person_id"), F.col("_p.atlas_id").alias("atlas_person_id"), "company_id",
                       "atlas_company_id", "started_at", _filled("ended_at").alias("finished_at"), F.col("position_name").alias("title"),
                       "description", F.lit("migration").alias("source"), F.coalesce("_name", "employer_name").alias("company_name"))


def educations(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    rows = _of_candidates(read("candidate_education").where(not_blank("school_name")), people)
    rows = keep_first(rows, ["id"], [F.col("started_at").asc_nulls_last(), F.col("candidate_id").asc()])
    return rows.select("id", _id(ctx, "id"), F.col("_p.id").alias("person_id"), F.col("_p.atlas_id").alias("atlas_person_id"),
                       F.col("school_name").alias("name"), F.col("degree_name").alias("degree"), _filled("specialization").alias("field_of_study"),
                       "description", F.lit("migration").alias("source"), _filled("started_at").alias("started_at"),
                       _filled("ended_at").alias("finished_at"))


def projects(read: Read, companies: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(read("job").where(not_blank("position_name")), "organization_id", companies, "atlas_id", "atlas_company_id")
    rows = fk_map(rows, "owner_id", users, "atlas_id", "atlas_owner_id", default=ctx.master())
    closed = code_map("status", CLOSE_REASON).isNotNull()
    return rows.select(
        "id", _id(ctx, "id"), F.col("position_name").alias("job_role"), *_days(), "description", F.lit("full_time").alias("contract_type"),
        F.lit("project").alias("class_type"), F.lit("1").alias("hire_target"), "owner_id", "atlas_owner_id",
        code_map("status", JOB_STATE, "active").alias("state"),
        F.when(closed, iso(F.col("updated_at").try_cast("timestamp"), "midnight")).alias("closed_at"),
        code_map("status", CLOSE_REASON).alias("close_reason"), F.col("organization_id").alias("company_id"), "atlas_company_id",
        F.lit(False).alias("public"), ctx.agency().alias("agency_id"), F.col("atlas_owner_id").alias("created_by_id"),
        F.col("atlas_owner_id").alias("updated_by_id"), F.col("id").alias("job_number"))


def candidates(read: Read, people: DataFrame, projects: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(_of_candidates(read("match"), people), "job_id", projects, "atlas_id", "atlas_project_id")
    rows = fk_map(rows, "creator_id", users, "atlas_id", "atlas_owner_id", default=ctx.master())
    dropped, day = _filled("dropped_at"), F.lit(ctx.midnight_iso)
    return rows.select(
        "id", _id(ctx, "id"), F.col("_p.id").alias("person_id"), F.col("_p.atlas_id").alias("atlas_person_id"), F.col("job_id").alias("project_id"),
        "atlas_project_id", F.lit("Candidate").alias("class_type"),
        stage_from_dates([(stage, [_filled(c)]) for stage, c in STEPS], "Added").alias("status"), F.col("creator_id").alias("owner_id"),
        "atlas_owner_id", day.alias("created_at"), day.alias("updated_at"), F.when(dropped.isNotNull(), "by_us").alias("rejection_type"),
        F.when(dropped.isNotNull(), "other").alias("rejection_reason"), iso(dropped.try_cast("timestamp"), "midnight").alias("rejected_at"))


def tables(read: Read, ctx: RunContext, out: Outputs, users: DataFrame) -> None:
    """``users``: the user mapping seed."""
    ours, firms = out.add("people", people(read, users, ctx)), out.add("companies", companies(read, users, ctx))
    jobs = out.add("projects", projects(read, firms, users, ctx))
    out.add("person_identities", person_identities(read, ours, ctx))
    out.add("company_identities", company_identities(read, firms, ctx))
    out.add("company_contacts", company_contacts(read, ours, firms, ctx))
    out.add("person_notes", person_notes(read, ours, users, ctx))
    out.add("experiences", experiences(read, ours, firms, ctx))
    out.add("educations", educations(read, ours, ctx))
    out.add("candidates", candidates(read, ours, jobs, users, ctx))
