"""Recruitly: candidates and contacts side by side, text timestamps in two orders, notes as fields."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.codes import code_map, first_pattern
from ..functions.contact import email_norm, in_domain, is_personal_email, linkedin_norm, phone_kind, phone_norm, website_norm
from ..functions.dates import older_than_months, parse_timestamp, string_to_timestamp
from ..functions.ids import uuid_from
from ..functions.location import prefer_filled
from ..functions.predicates import has_file_type, not_blank
from ..functions.text import CRLF, clean_html, drop_boilerplate, html_to_markdown
from ..operators.dedupe import filled_first, keep_first
from ..operators.joins import fk_map, one_per_key
from ..operators.reshape import union_all, unpivot
from ..plans.companies import MISSING_TITLE
from ..plans.identities import identity_cell, identity_table
from ..plans.notes import build_section_notes
from ..plans.salaries import build_salaries_from_text
from ..sources.sinks import Outputs

Read = Callable[[str], DataFrame]

# What the vendor's texts mean, first match first.
PIPELINE_STATUS = {"Placed": "Hired", "Interview": "Client IV", "Offer": "Offer", "Applied": "Added"}
REJECT_REASONS = [("%unsuccessful%", "not_qualified"), ("%accepted%", "accepted_another_offer"),
                  ("%found own job%", "accepted_another_offer"), ("%placed elsewhere%", "accepted_another_offer")]
REJECT_TYPES = [("%withdrew%", "self"), ("%unsuccessful%", "by_client"), ("%accepted%", "self"),
                ("%found own job%", "self"), ("%staying in own job%", "self"), ("%withdrawn offer%", "self"),
                ("%placed elsewhere%", "by_us"), ("%wasnt impressed%", "self")]
CONTRACT_TYPES = [("%permanent%", "full_time"), ("%full%", "full_time"), ("%contract%", "contract"),
                  ("%part%", "part_time")]
DUMMY_JOB = "This is a dummy job"
PERSON_NOTES = [("rect_pref", "Preferences", "preferences"), ("rect_reasons", "Reasons for leaving", "reasons_for_leaving"),
                ("rect_internal", "Internal notes", "internal_notes")]
COMPANY_NOTES = [("rect_internal", "Internal notes", "internal_notes"), ("rect_benefits", "Benefits package", "benefits_package"),
                 ("rect_terms", "Terms agreed", "terms_agreed")]
DOCUMENTS = ("pdf", "docx", "doc")


def _true(column: str) -> Column:
    """A missing flag text is not true."""
    return F.lower(F.coalesce(F.col(column).cast("string"), F.lit("false"))) == "true"


def _stamps() -> list[Column]:
    return [string_to_timestamp("createdon").alias("created_at"), string_to_timestamp("modifiedon").alias("updated_at")]


def users(read: Read, ctx: RunContext, prior: DataFrame | None) -> DataFrame:
    email = email_norm("email")
    name = F.concat_ws(" ", F.coalesce(prefer_filled("first_name"), F.lit("")), F.coalesce(prefer_filled("surname"), F.lit("")))
    staff = read("users").where(in_domain(email, ctx.domain)).select(
        F.col("user_id").alias("id"), uuid_from(ctx.client, "user_id").alias("atlas_id"), name.alias("name"),
        string_to_timestamp("createdon", "midnight_zulu").alias("created_at"),
        string_to_timestamp("modifiedon").alias("updated_at"), email.alias("email"),
        F.when(_true("is_disabled"), "disabled").otherwise("active").alias("status"),
        parse_timestamp("createdon").alias("_added"))
    newest = keep_first(staff, ["email"], [F.col("_added").desc_nulls_last(), F.col("id").asc()]).drop("_added")
    if prior is None:
        return newest
    known = one_per_key(prior.where("email IS NOT NULL"), [F.lower("email").alias("id")],
                        F.min(F.struct("atlas_id", "name", "status")).alias("p"))
    rows = fk_map(newest, F.lower("email"), known, "p", "_p")
    return rows.select("id", *[F.coalesce(F.col(f"_p.{c}"), F.col(c)).alias(c) for c in ("atlas_id", "name", "status")],
                       "created_at", "updated_at", "email")


def people(read: Read, users: DataFrame, ctx: RunContext) -> DataFrame:
    def side(table: str, key: str, overview: str, street: Column) -> DataFrame:
        rows = fk_map(read(table), "owner_id", users, "id", "created_by_id")
        rows = fk_map(rows, "owner_id", users, "atlas_id", "created_by_atlas_id", default=ctx.master())
        return rows.select(
            F.col(key).alias("id"), ctx.record_id(key).alias("atlas_id"), prefer_filled("first_name").alias("first_name"),
            prefer_filled("surname").alias("last_name"), F.trim(overview).alias("overview"),
            street.alias("location_street_address"), prefer_filled("city").alias("location_locality"),
            prefer_filled("region").alias("location_region"), prefer_filled("country").alias("location_country"),
            prefer_filled("postcode").alias("location_postal_code"), F.lit("active").alias("responsiveness"),
            F.lit("regular").alias("candidate_status"), *_stamps(), "created_by_id", "created_by_atlas_id",
            F.col("created_by_id").alias("updated_by_id"), F.col("created_by_atlas_id").alias("updated_by_atlas_id"),
            ctx.agency().alias("agency_id"))
    return side("candidates", "candidate_id", "internal_overview", F.lit(None).cast("string")).unionByName(
        side("contacts", "contact_id", "description", prefer_filled("address_line")))


def person_identities(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    def mail(column: str) -> dict[str, Column]:
        value = email_norm(column)
        private = is_personal_email(value)
        return identity_cell("email", F.when(value.like("%@%.%"), value), F.when(private, "personal").otherwise("corporate"), private)

    def number(column: str, source: str) -> dict[str, Column]:
        value, kind = phone_norm(column), phone_kind(F.lit(source))
        return identity_cell("phone", F.when(F.length(value) > 3, value), kind, kind == "personal")

    profile = linkedin_norm("linkedin")
    link = identity_cell("linkedin", F.when(profile.contains("linkedin.com"), profile), F.lit(None).cast("string"), F.lit(False))
    keep = ["person_id", "createdon"]
    rows = union_all(
        unpivot(read("candidates").withColumn("person_id", F.col("candidate_id")), keep, [
            mail("email"), mail("alternate_email"), number("mobile", "mobile"), number("work_phone", "work"),
            number("home_phone", "home"), link]),
        unpivot(read("contacts").withColumn("person_id", F.col("contact_id")), keep, [
            mail("email"), number("mobile", "mobile"), number("work_phone", "work")]))
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    oldest = [parse_timestamp("createdon").asc_nulls_last(), F.col("person_id").asc(), F.col("identity_type_type").asc()]
    return identity_table(keep_first(rows, ["type", "value"], oldest), ctx)


def companies(read: Read, ctx: RunContext) -> DataFrame:
    status, kind = F.lower(F.trim("status")), F.lower(F.trim("company_type"))
    relationship = (F.when(status.isin("is live", "live", "active") | kind.contains("client"), "client")
                    .when(kind.contains("prospect") | status.contains("prospect"), "target").otherwise("none"))
    return read("companies").where(not_blank("company_name")).select(
        F.col("company_id").alias("id"), ctx.record_id("company_id").alias("atlas_id"), F.trim("company_name").alias("name"),
        relationship.alias("relationship"), html_to_markdown("description").alias("summary"),
        prefer_filled("address_line").alias("location_street_address"), prefer_filled("city").alias("location_locality"),
        prefer_filled("region").alias("location_region"), prefer_filled("post_code").alias("location_postal_code"),
        prefer_filled("country").alias("location_country"), *_stamps())


def company_identities(read: Read, companies: DataFrame, ctx: RunContext) -> DataFrame:
    number, site, profile = phone_norm("land_phone"), website_norm("website"), linkedin_norm("linkedin")
    rows = unpivot(read("companies"), ["company_id", "createdon", "modifiedon"], [
        {"type": F.lit("phone"), "value": F.when(F.length(number) > 3, number)},
        {"type": F.lit("website"), "value": F.when(site.contains(".") & ~site.contains("linkedin.com"), site)},
        {"type": F.lit("linkedin"), "value": F.when(profile.contains("linkedin.com"), profile)}])
    rows = fk_map(rows, "company_id", companies, "atlas_id", "atlas_company_id", policy="exclude")
    rows = keep_first(rows, ["type", "value"], [parse_timestamp("createdon").asc_nulls_last(), F.col("company_id").asc()])
    return rows.select(ctx.record_id("company_id", "type", "value").alias("atlas_id"), "company_id", "atlas_company_id",
                       "type", "value", *_stamps(), (F.col("type") == "website").alias("is_primary"))


def company_contacts(read: Read, people: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(read("contacts"), "contact_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    known = companies.select("id", F.struct("atlas_id", "relationship").alias("_c"))
    rows = fk_map(rows, "company_id", known, "_c", "_c", policy="exclude").withColumn("_title", prefer_filled("headline"))
    rows = keep_first(rows, ["contact_id", "company_id"], [
        filled_first("_title"), parse_timestamp("modifiedon").desc_nulls_last(), F.col("_title").asc()])
    key = F.concat(F.col("contact_id").cast("string"), F.lit("contact"), F.col("company_id").cast("string"))
    return rows.select(
        key.alias("id"), uuid_from(ctx.client, key).alias("atlas_id"), F.col("contact_id").alias("person_id"),
        "atlas_person_id", "company_id", F.col("_c.atlas_id").alias("atlas_company_id"), *_stamps(),
        code_map("_c.relationship", {"client": "client", "target": "prospect", "prospect": "prospect"}, "none").alias("relationship"),
        F.coalesce("_title", F.lit(MISSING_TITLE)).alias("title"), ctx.agency().alias("agency_id"))


def projects(read: Read, companies: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    """Archived jobs and those older than six months arrive closed."""
    rows = fk_map(read("jobs"), "company_id", companies, "atlas_id", "atlas_company_id", policy="exclude")
    rows = fk_map(rows, "owner_id", users, "atlas_id", "atlas_owner_id", default=ctx.master())
    closed = _true("archived") | F.coalesce(older_than_months(parse_timestamp("createdon"), ctx.today), F.lit(False))
    return rows.select(
        F.col("job_id").alias("id"), ctx.record_id("job_id").alias("atlas_id"), prefer_filled("title").alias("job_role"),
        html_to_markdown(drop_boilerplate("job_description", DUMMY_JOB)).alias("job_description"),
        html_to_markdown(drop_boilerplate("short_description", DUMMY_JOB)).alias("notes"), "company_id", "atlas_company_id",
        *_stamps(), F.when(closed, "closed").otherwise("active").alias("state"),
        F.when(closed, "worked_lost").alias("close_reason"),
        F.when(closed, string_to_timestamp("modifiedon")).alias("closed_at"),
        first_pattern(F.trim("job_type"), CONTRACT_TYPES, "full_time").alias("contract_type"),
        prefer_filled("job_location").alias("location_locality"), F.col("job_reference_id").alias("job_number"), "owner_id",
        "atlas_owner_id", ctx.agency().alias("agency_id"), F.lit("project").alias("class_type"))


def project_company_contacts(read: Read, projects: DataFrame, people: DataFrame, contacts: DataFrame) -> DataFrame:
    held = contacts.select(F.col("person_id").alias("contact_id"), "company_id", F.col("id").alias("company_contact_id"),
                           F.col("atlas_id").alias("atlas_company_contact_id"))
    rows = read("jobs").select("job_id", "contact_id", "company_id").join(held, ["contact_id", "company_id"])
    rows = fk_map(rows, "job_id", projects, "atlas_id", "atlas_project_id", policy="exclude")
    rows = fk_map(rows, "contact_id", people, "atlas_id", "atlas_person_id")
    return rows.select(F.col("job_id").alias("project_id"), "atlas_project_id", F.col("contact_id").alias("person_id"),
                       "atlas_person_id", "company_contact_id", "atlas_company_contact_id").distinct()


def candidates(read: Read, projects: DataFrame, people: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    """Pipeline rows; a candidate marked placed is hired wherever they are listed."""
    rows = fk_map(read("job_pipelines"), "job_id", projects, "atlas_id", "atlas_project_id", policy="exclude")
    rows = fk_map(rows, "candidate_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = keep_first(rows, ["job_id", "candidate_id"], [
        parse_timestamp("modifiedon").desc_nulls_last(), parse_timestamp("createdon").desc_nulls_last(), F.col("pipeline_id").asc()])
    rows = fk_map(rows, "candidate_id", read("candidates"), "status", "_status", "candidate_id", policy="exclude")
    rows = fk_map(rows, "createdby", users, "atlas_id", "atlas_owner_id", default=ctx.master())
    placed = F.coalesce((F.col("pipeline_status") == "Placed") | (F.col("_status") == "Placed"), F.lit(False))
    rejected, why = _true("is_rejected"), F.coalesce("reject_reason", F.lit(""))
    changed = string_to_timestamp("modifiedon")
    return rows.select(
        F.col("pipeline_id").alias("id"), ctx.record_id("pipeline_id").alias("atlas_id"), *_stamps(),
        F.col("job_id").alias("project_id"), "atlas_project_id", F.col("candidate_id").alias("person_id"), "atlas_person_id",
        F.col("createdby").alias("owner_id"), "atlas_owner_id", F.lit("Candidate").alias("class_type"),
        F.when(placed, "Hired").otherwise(code_map("pipeline_status", PIPELINE_STATUS, "Added")).alias("status"),
        F.when(rejected, changed).alias("rejected_at"),
        F.when(rejected, first_pattern(why, REJECT_TYPES, "by_us")).alias("rejection_type"),
        F.when(rejected, first_pattern(why, REJECT_REASONS, "other")).alias("rejection_reason"),
        F.when(rejected, F.col("atlas_owner_id")).alias("atlas_rejected_by_id"), F.when(placed, changed).alias("hired_at"))


def task_notes(read: Read, companies: DataFrame, ctx: RunContext) -> DataFrame:
    """Tasks linked to a company, invoices left out."""
    tasks = read("tasks").where(~F.col("subject").ilike("%invoice%") & F.col("linked_to_records").ilike("COMPANY:%"))
    by_text = companies.select(F.col("id").cast("string").alias("id"), F.struct("id", "atlas_id").alias("_c"))
    rows = fk_map(tasks, F.regexp_replace(F.trim("linked_to_records"), "^COMPANY:", ""), by_text, "_c", "_c", policy="exclude")
    message = F.nullif(clean_html("message"), F.lit(""))
    return rows.select(
        F.concat(F.lit("rect_task_"), F.col("task_id").cast("string")).alias("id"),
        ctx.record_id("_c.id", F.lit("::task::"), "task_id").alias("atlas_id"), F.col("_c.id").alias("company_id"),
        F.col("_c.atlas_id").alias("atlas_company_id"),
        F.concat_ws(CRLF, F.concat(F.lit("Task: "), F.trim(F.coalesce("subject", F.lit("")))), message).alias("text"),
        F.lit("manual").alias("type"), *_stamps(), F.lit(None).cast("string").alias("created_by_id"),
        ctx.master().alias("created_by_atlas_id"))


def files(read: Read, owners: DataFrame, entity: str) -> DataFrame:
    """Attachments of a record, and the CV on file of a candidate."""
    def listed(rows: DataFrame, key: str, name: str, folder: str) -> DataFrame:
        kept = rows.where(not_blank(name) & has_file_type(name, DOCUMENTS))
        return fk_map(kept, key, owners, "atlas_id", f"atlas_{entity}_id", policy="exclude").select(
            F.col(key).alias(f"{entity}_id"), f"atlas_{entity}_id", F.concat(F.lit(folder), name).alias("file_name"),
            F.col(name).alias("actual_file_name"),
            F.when(F.lower(name).rlike("resume|cv|profile"), "resume").otherwise("other").alias("type"))

    attached = listed(read("attachments"), "linked_to", "attachment_name", "attachments/")
    if entity == "company":
        return attached.drop("type")
    return listed(read("candidates"), "candidate_id", "internal_cv_file_name", "internalcvs/").unionByName(attached)


def tables(read: Read, ctx: RunContext, out: Outputs, prior_users: DataFrame | None = None) -> None:
    staff = out.add("users", users(read, ctx, prior_users))
    ours = out.add("people", people(read, staff, ctx))
    firms = out.add("companies", companies(read, ctx))
    contacts = out.add("company_contacts", company_contacts(read, ours, firms, ctx))
    jobs = out.add("projects", projects(read, firms, staff, ctx))
    out.add("person_identities", person_identities(read, ours, ctx))
    out.add("company_identities", company_identities(read, firms, ctx))
    out.add("project_company_contacts", project_company_contacts(read, jobs, ours, contacts))
    out.add("candidates", candidates(read, jobs, ours, staff, ctx))
    times = {"added_at": parse_timestamp("createdon"), "modified_at": parse_timestamp("modifiedon")}
    held = read("candidates").withColumns({**times, "person_id": F.col("candidate_id"), "created_by_id": F.col("owner_id")})
    out.add("person_notes", build_section_notes(held, ours, ctx, PERSON_NOTES, "person", staff))
    firm_notes = build_section_notes(read("companies").withColumns(times), firms, ctx, COMPANY_NOTES, "company")
    out.add("company_notes", firm_notes.unionByName(task_notes(read, firms, ctx)))
    pay = read("candidates").select(F.col("candidate_id").alias("person_id"), "current_salary", "expected_pay",
                                    F.col("createdon").alias("created_on"), F.col("modifiedon").alias("modified_on"))
    out.add("person_salaries", build_salaries_from_text(pay, ours, ctx))
    out.add("file_person_mapping", files(read, ours, "person"))
    out.add("company_map_files", files(read, firms, "company"))
