"""Ezekia: separate tables per kind of contact detail, statuses as a tagged history.

The list of every contact of a project's company is not built: it pairs all projects with all contacts of a company.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.codes import headcount_range
from ..functions.contact import email_domain, email_norm, linkedin_norm, phone_norm
from ..functions.dates import drop_sentinel, iso
from ..functions.ids import uuid_from
from ..functions.predicates import not_blank
from ..functions.text import clean_html
from ..operators.dedupe import keep_first
from ..operators.joins import fk_map, one_per_key
from ..operators.reshape import union_all
from ..plans.candidates import build_candidates_from_history
from ..plans.identities import CLASS_TYPES
from ..plans.notes import build_channel_meetings, build_email_notes
from ..plans.salaries import build_salaries_with_bonus
from ..sources.sinks import Outputs

# What the vendor's status tags mean. Tags that a firm has made for itself are options of the migration.
STATUS = {
    "Identified": "Added", "Interested": "Added", "Shortlisted: Presented to Client": "Presented",
    "Client Interview: 1st round": "Client IV", "Client Interview: 2nd round": "Client IV",
    "Client Interview: 3rd /4th round": "Client IV", "Offered": "Offer", "Accepted / Contract Signed": "Hired",
}
REJECTION = {
    "Not Responded": "by_us", "Not Interested": "by_us", "Client Rejected": "by_client",
    "Already in process - direct with Client": "by_client", "Candidate or Client put on hold": "by_us",
    "Do not approach - Client in contact / has contacted": "by_client",
    "Suggested: Client contact directly": "by_client", "Withdrew": "self",
}
# Tags that never count as the standing status.
NOT_STANDING = ("Do not approach - Client in contact / has contacted", "Client Rejected", "Not Interested",
                "Not Responded")

Read = Callable[[str], DataFrame]


def _ts(name: str) -> Column:
    return F.col(name).try_cast("timestamp")


def _day(name: str) -> Column:
    return iso(_ts(name), "midnight")


def _id(ctx: RunContext, *parts: Column | str) -> Column:
    return uuid_from(ctx.client, *parts).alias("atlas_id")


def users(read: Read, ctx: RunContext, prior: DataFrame) -> DataFrame:
    """Search staff of the agency's domain that the target already knows."""
    staff = read("users").where((F.col("role") == "search") & email_domain("email").ilike(ctx.domain))
    known = one_per_key(prior.where(not_blank("email")), [F.lower(F.trim("email")).alias("_email")],
                        F.min(F.struct("id", "name", "email", "status")).alias("_p"))
    return staff.join(known, F.lower(F.trim(F.col("email"))) == F.col("_email")).select(
        F.col("id").cast("string").alias("id"), F.coalesce("_p.id", uuid_from(ctx.client, "id")).alias("atlas_id"),
        F.coalesce("_p.name", "fullname").alias("name"), F.coalesce("_p.email", "email").alias("email"),
        F.coalesce("_p.status", F.lit("disabled")).alias("status"))


def people(read: Read, ctx: RunContext) -> DataFrame:
    """People with the place of their best position: with a location, then primary, then the newest."""
    located, primary = F.col("location_id").isNotNull(), F.coalesce(F.col("primary"), F.lit(False))
    rank = F.when(located, F.when(primary, 0).otherwise(1)).otherwise(F.when(primary, 2).otherwise(3))
    best = keep_first(read("people_positions"), ["person_id"], [
        rank, F.coalesce(_ts("updated_at"), _ts("created_at")).desc_nulls_last(), F.col("id").desc()])
    place = fk_map(best.select("person_id", "location_id"), "location_id", read("locations"), "location_name", "place",
                   "id")
    rows = fk_map(read("people"), "id", place, "place", "location_locality", "person_id")
    return rows.select(
        "id", _id(ctx, "id"), F.col("firstname").alias("first_name"), F.col("lastname").alias("last_name"),
        _day("created_at").alias("created_at"), _day("updated_at").alias("updated_at"), "location_locality",
        ctx.master().alias("created_by_id"), ctx.master().alias("updated_by_id"),
        ctx.master().alias("created_by_atlas_id"), ctx.master().alias("updated_by_atlas_id"),
        F.lit("active").alias("responsiveness"), F.lit("regular").alias("candidate_status"),
        ctx.agency().alias("agency_id"))


def companies(read: Read, ctx: RunContext) -> DataFrame:
    least = F.split_part(F.replace("size", F.lit(" employees"), F.lit("")), F.lit("-"), F.lit(1)).try_cast("int")
    return read("search_firms_clients").select(
        F.col("client_id").alias("id"), _id(ctx, "client_id"), _day("created_at").alias("created_at"),
        _day("updated_at").alias("updated_at"), "name", F.col("description").alias("summary"),
        headcount_range(least).alias("company_size"),
        F.when(F.col("label") == "client", "client").otherwise("none").alias("relationship"),
        ctx.master().alias("created_by_atlas_id"), ctx.master().alias("updated_by_atlas_id"))


def person_identities(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    """Addresses, numbers and profiles; the oldest holder of a value keeps it."""
    def kind(table: str, prefix: str, type_: str, raw: str, value: Column, scope: Column, favourite: Column,
             keep: Column) -> DataFrame:
        owner = F.col(f"{prefix}able_id")
        rows = read(table).where((F.col(f"{prefix}able_type") == "person") & keep).select(
            F.concat(F.col("id").cast("string"), F.lit(f"_{type_}")).alias("id"), _id(ctx, "id", raw),
            owner.alias("person_id"), _ts("created_at").alias("_created"), _day("created_at").alias("created_at"),
            _day("updated_at").alias("updated_at"), F.lit(type_).alias("type"), value.alias("value"),
            scope.alias("identity_type_type"), F.lit(CLASS_TYPES[type_]).alias("class_type"),
            favourite.alias("favourite"))
        rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
        return keep_first(rows, ["value"], [F.col("_created").asc_nulls_last(), F.col("id").asc()]).drop("_created")

    work = F.when(F.col("type") == "work", "corporate").otherwise("personal")
    default = F.coalesce(F.col("is_default") == 1, F.lit(False))
    rows = union_all(
        kind("emails", "email", "email", "address", email_norm("address"), work, default, F.lit(True)),
        kind("phones", "phone", "phone", "number", phone_norm("number_searchable"), work, default, F.lit(True)),
        kind("links", "link", "linkedin", "url", linkedin_norm("url"), F.lit("personal"), F.lit(False),
             F.col("type") == "linkedin"))
    return rows.withColumns({
        "source": F.lit("migration"), "created_by_id": ctx.master(), "created_by_atlas_id": ctx.master(),
        "updated_by_atlas_id": ctx.master(), "bounced": F.lit(False), "hidden": F.lit(False), "active": F.lit(True)})


def company_identities(read: Read, companies: DataFrame, ctx: RunContext) -> DataFrame:
    rows = read("links").where("linkable_type = 'client'").select(
        "id", _id(ctx, "id"), F.col("linkable_id").alias("company_id"), _ts("created_at").alias("_created"),
        _day("created_at").alias("created_at"), _day("updated_at").alias("updated_at"),
        linkedin_norm("url").alias("value"), "type", (F.col("type") == "website").alias("is_primary"))
    rows = fk_map(rows, "company_id", companies, "atlas_id", "atlas_company_id", policy="exclude")
    return keep_first(rows, ["value"], [F.col("_created").asc_nulls_last(), F.col("id").asc()]).drop("_created")


def company_contacts(read: Read, people: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    """Positions still held, the longest-running one per person and company."""
    held = read("people_positions").where(F.col("end_date").try_cast("date") > F.lit(ctx.today).cast("date"))
    held = keep_first(held, ["person_id", "company_id"], [F.col("end_date").desc_nulls_last(), F.col("id").asc()])
    rows = fk_map(held.where(not_blank("title")), "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    known = companies.select("id", F.struct("atlas_id", "relationship").alias("_c"))
    rows = fk_map(rows, "company_id", known, "_c", "_c", policy="exclude")
    return rows.select(
        "id", "person_id", _id(ctx, "id", "company_id"), iso(_ts("created_at")).alias("created_at"),
        iso(F.coalesce(_ts("updated_at"), _ts("created_at"))).alias("updated_at"), "company_id", "title",
        "atlas_person_id", F.col("_c.atlas_id").alias("atlas_company_id"),
        F.col("_c.relationship").alias("relationship"))


def company_notes(read: Read, companies: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    rows = read("search_firms_clients").where(not_blank("speciality"))
    rows = fk_map(rows, "client_id", companies, "atlas_id", "atlas_company_id", policy="exclude")
    rows = fk_map(rows, F.col("user_id").cast("string"), users, "atlas_id", "created_by_atlas_id",
                  default=ctx.master())
    return rows.select(
        F.concat(F.col("client_id").cast("string"), F.lit("_note")).alias("id"), _id(ctx, "client_id", "speciality"),
        _day("created_at").alias("created_at"), _day("updated_at").alias("updated_at"),
        clean_html("speciality").alias("text"), F.lit("manual").alias("type"), F.col("client_id").alias("company_id"),
        "atlas_company_id", F.coalesce(F.col("user_id").cast("string"), F.lit("1")).alias("created_by_id"),
        "created_by_atlas_id")


def experiences(read: Read, people: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(read("people_positions"), "person_id", people, "atlas_id", "atlas_person_id")
    known = companies.select("id", F.struct("atlas_id", "name").alias("_c"))
    rows = fk_map(rows, "company_id", known, "_c", "_c")
    name = F.coalesce("company", "_c.name")
    return rows.where(F.col("start_date").isNotNull() & not_blank("title") & not_blank(name)).select(
        "id", _id(ctx, "id"), _day("created_at").alias("created_at"), _day("updated_at").alias("updated_at"),
        F.lit("migration").alias("source"), "person_id", "atlas_person_id", name.alias("company_name"), "company_id",
        F.col("_c.atlas_id").alias("atlas_company_id"), "title", F.col("start_date").cast("string").alias("started_at"),
        drop_sentinel("end_date").alias("finished_at"), F.col("summary").alias("description"),
        ctx.master().alias("created_by_id"), ctx.master().alias("created_by_atlas_id"))


def educations(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    def new_year(column: str) -> Column:
        return F.when(F.col(column) != 0, F.concat(F.col(column).cast("string"), F.lit("-01-01")))

    rows = fk_map(read("people_educations").where(not_blank("school")), "person_id", people, "atlas_id",
                  "atlas_person_id", policy="exclude")
    return rows.select(
        "id", _id(ctx, "id"), _day("created_at").alias("created_at"), _day("updated_at").alias("updated_at"),
        "person_id", "atlas_person_id", F.lit("migration").alias("source"), new_year("start").alias("started_at"),
        new_year("end").alias("finished_at"), "degree", F.col("field").alias("field_of_study"),
        F.col("school").alias("name"), F.coalesce("education_searchable", "summary").alias("description"))


def projects(read: Read, companies: DataFrame, users: DataFrame, ctx: RunContext,
             fallback_company: str | None) -> DataFrame:
    """Briefs that are not deleted. The export holds finished work only, so every project arrives closed."""
    rows = read("search_firms_briefs").where("deleted_at IS NULL")
    rows = fk_map(rows, F.col("user_id").cast("string"), users, "atlas_id", "atlas_owner_id", default=ctx.master())
    rows = fk_map(rows, "client_id", companies, "atlas_id", "atlas_company_id",
                  default=F.lit(fallback_company).cast("string"))
    ranges = one_per_key(read("briefs_compensation_ranges"), [F.col("brief_id")],
                         F.min(F.struct("min", "max", "currency")).alias("_r"))
    rows = fk_map(rows, "brief_id", ranges, "_r", "_r", "brief_id")
    ends = [F.col(f"_r.{c}").cast("string") for c in ("min", "max")]
    return rows.select(
        F.col("brief_id").alias("id"), _id(ctx, "brief_id"), _day("created_at").alias("created_at"),
        _day("updated_at").alias("updated_at"), F.col("title").alias("job_role"), F.col("client_id").alias("company_id"),
        "atlas_company_id", F.lit("false").alias("public"), F.lit("project").alias("class_type"),
        F.coalesce(_day("end_date"), F.lit(ctx.midnight_iso)).alias("closed_at"),
        F.nullif(F.concat_ws(" - ", *ends), F.lit("")).alias("salary"), F.col("_r.currency").alias("salary_currency"),
        F.lit("closed").alias("state"), F.when(F.col("end_date").isNotNull(), "won").otherwise("cancelled").alias(
            "close_reason"),
        F.coalesce(F.col("user_id").cast("string"), F.lit("1")).alias("owner_id"), "atlas_owner_id",
        F.col("description").alias("job_description_text"), F.col("brief_id").alias("job_number"))


def history(read: Read) -> DataFrame:
    """Candidate status tags of people on assignments."""
    tags = read("search_firms_status_tags").where("tag_type = 'candidate'")
    rows = read("statusables").where("statusable_type = 'person' AND constraint_type = 'assignment'")
    rows = fk_map(rows, "status_tag_id", tags, "tag_text", "status", policy="exclude")
    return rows.select(F.col("statusable_id").alias("person_id"), F.col("constraint_id").alias("project_id"), "status",
                       F.coalesce(_ts("updated_at"), _ts("created_at")).alias("ts"), F.col("id").alias("event_id"))


def person_notes(read: Read, people: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    """Notes people wrote, and the mails linked to a person."""
    rows = read("notes").where((F.col("is_automated") == 0) & (F.col("notable_type") == "person")
                               & (F.lower("text") != "added to sourcewhale"))
    rows = fk_map(rows, "notable_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = fk_map(rows, F.col("user_id").cast("string"), users, "atlas_id", "created_by_atlas_id", default=ctx.master())
    written = rows.select(
        F.col("id").cast("string").alias("id"), _id(ctx, "id"), _day("created_at").alias("created_at"),
        _day("updated_at").alias("updated_at"), clean_html("text").alias("text"), F.col("notable_id").alias("person_id"),
        "atlas_person_id", F.col("user_id").cast("string").alias("created_by_id"), "created_by_atlas_id",
        F.lit("manual").alias("type"))
    mails = read("outlook_emails").select(
        F.col("id").cast("string").alias("id"), F.col("user_id").cast("string").alias("created_by_id"),
        F.col("from").alias("sender"), F.col("to").alias("receiver"), "subject",
        F.coalesce("text", "raw_html").alias("body"), _ts("created_at").alias("created_at"))
    links = read("outlook_emailables").select(F.col("outlook_email_id").cast("string").alias("email_id"), "person_id")
    return written.unionByName(build_email_notes(mails, links, people, users, ctx))


def meetings(read: Read) -> DataFrame:
    return read("meetings").select(
        "id", F.col("user_id").cast("string").alias("created_by_id"), "channel_type", "channel_id",
        F.coalesce("details", "agenda", "note").alias("details"),
        F.coalesce(_ts("start_date"), _ts("start_date_utc")).alias("start_at"),
        F.coalesce(_ts("end_date_utc"), _ts("end_date")).alias("end_at"), _ts("created_at").alias("created_at"),
        _ts("updated_at").alias("updated_at"))


def salaries(read: Read) -> DataFrame:
    """Permanent aspirations with the person and the notes of the aspiration they belong to."""
    wishes = read("people_aspirations").select(
        F.col("id").alias("aspiration_id"), "person_id", F.col("summary").alias("notes"), F.col("base").alias("_base"),
        F.col("bonus").alias("_bonus"), _ts("created_at").alias("created_at"), _ts("updated_at").alias("updated_at"))
    pay = read("aspirations_permanent").select("id", "aspiration_id", "base", "bonus", "currency")
    return pay.join(wishes, "aspiration_id").withColumns({
        "base": F.coalesce("_base", "base"), "bonus": F.coalesce("bonus", "_bonus")})


def tables(read: Read, ctx: RunContext, out: Outputs, prior_users: DataFrame,
           fallback_company: str | None = None, own_status: Mapping[str, str] | None = None,
           own_rejection: Mapping[str, str] | None = None, own_not_standing: Sequence[str] = ()) -> None:
    """``prior_users``: id, name, email, status of the staff the target knows. ``own_...``: the firm's own status tags, by what
    they mean, beside the vendor's."""
    staff = out.add("users", users(read, ctx, prior_users))
    ours, firms = out.add("people", people(read, ctx)), out.add("companies", companies(read, ctx))
    jobs = out.add("projects", projects(read, firms, staff, ctx, fallback_company))
    owner = F.coalesce(F.nullif(F.trim(F.col("added_by").cast("string")), F.lit("")), F.lit("1"))
    candidacies = read("briefs_candidates").select(
        "id", F.col("brief_id").alias("project_id"), "person_id", owner.alias("owner"),
        _ts("created_at").alias("created_at"), _ts("updated_at").alias("updated_at"))
    out.add("person_identities", person_identities(read, ours, ctx))
    out.add("company_identities", company_identities(read, firms, ctx))
    out.add("company_contacts", company_contacts(read, ours, firms, ctx))
    out.add("company_notes", company_notes(read, firms, staff, ctx))
    out.add("experiences", experiences(read, ours, firms, ctx))
    out.add("educations", educations(read, ours, ctx))
    out.add("candidates", build_candidates_from_history(candidacies, history(read), jobs, ours, staff, ctx, STATUS | dict(own_status or {}),
                                                        REJECTION | dict(own_rejection or {}), (*NOT_STANDING, *own_not_standing)))
    out.add("person_notes", person_notes(read, ours, staff, ctx))
    out.add("meetings", build_channel_meetings(meetings(read), candidacies, ours, staff, ctx))
    out.add("person_salaries", build_salaries_with_bonus(salaries(read), ours, ctx))
