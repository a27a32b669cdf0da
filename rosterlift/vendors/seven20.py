"""Seven20: a Salesforce package; contacts carry the candidate they duplicate, tasks are notes or meetings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.codes import code_map, headcount_range
from ..functions.contact import email_norm, in_domain, is_personal_email, linkedin_norm, phone_norm
from ..functions.dates import iso, older_than_months
from ..functions.ids import uuid_from
from ..functions.location import location_locality
from ..functions.predicates import not_blank
from ..functions.text import CRLF, clean_html, scrub, sections, strip_tags
from ..operators.chains import survivors
from ..operators.dedupe import keep_first
from ..operators.joins import exclude, exists_flag, fk_map, lookup_by_text, one_per_key, survivor_key
from ..operators.reshape import union_all, unpivot
from ..plans.identities import identity_cell, identity_table
from ..sources.sinks import Outputs

Read = Callable[[str], DataFrame]

# What the vendor's statuses mean.
COMPANY_STATUS = {"Live": "client", "New": "target", "Terms Sent": "target", "Prospecting": "target"}
CONTACT_STATUS = {"New": "prospect", "Live": "client", "Terms Sent": "client", "Prospecting": "client"}
JOB_STATE = {"Lost": "closed", "Placed": "closed"}
STAGES = {"Rejected": "Added", "Submitted": "Presented", "Third Stage Interview": "Client IV",
          "Second Stage Interview": "Client IV", "First Stage Interview": "Client IV", "Longlist": "Added",
          "Placement": "Hired", "Shortlist": "Added", "Offer": "Offer"}
REJECT_TYPES = {"Communication Skills": "by_us", "Experience": "by_us", "Skill Set": "by_us", "Job Closed": "by_client",
                "No Feedback Provided": "by_client", "Rejected Offer": "self", "No Show": "self"}
REJECT_REASONS = {"Communication Skills": "cultural_fit", "Experience": "not_qualified", "Skill Set": "not_qualified",
                  "Rejected Offer": "accepted_another_offer"}
OVERVIEW = [("Experience", "experience__c"), ("Motivations", "motivations__c"), ("Needs", "needs__c"),
            ("Alternative Activity", "alternative_activity__c"), ("Sell", "sell__c")]
CLIENT_CONTACT = "Client Contact"


def _ts(name: str) -> Column:
    return F.col(name).try_cast("timestamp")


def _stamps(style: str = "seconds") -> list[Column]:
    return [iso(_ts("createddate"), style).alias("created_at"), iso(_ts("lastmodifieddate"), style).alias("updated_at")]


def _live(read: Read, table: str) -> DataFrame:
    return read(table).where("isdeleted = 0")


def users(read: Read, ctx: RunContext, prior: DataFrame | None) -> DataFrame:
    staff = read("user").where(in_domain("email", ctx.domain.lower())).select(
        "id", uuid_from(ctx.client, "id", "email").alias("atlas_id"), F.concat("firstname", F.lit(" "), "lastname").alias("name"),
        "email", F.when(F.col("isactive") == 1, "active").otherwise("disabled").alias("status"))
    if prior is None:
        return staff
    known = one_per_key(prior.where("email IS NOT NULL"), [F.lower("email").alias("id")],
                        F.min(F.struct("atlas_id", "name", "email")).alias("p"))
    rows = fk_map(staff, F.lower("email"), known, "p", "_p")
    return rows.select("id", *[F.coalesce(F.col(f"_p.{c}"), F.col(c)).alias(c) for c in ("atlas_id", "name", "email")], "status")


def people(read: Read, dupes: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    """Contacts that duplicate no candidate, with their sectioned overview."""
    rows = exclude(_live(read, "contact"), "id", dupes, "contact_id")
    rows = fk_map(rows, "createdbyid", users, "atlas_id", "created_by_atlas_id", default=ctx.master())
    rows = fk_map(rows, "lastmodifiedbyid", users, "atlas_id", "updated_by_atlas_id", default=ctx.master())
    address = ("mailingstreet", "mailingcity", "mailingstate", "mailingpostalcode", "mailingcountry")
    names = ("location_street_address", "location_metro", "location_region", "location_postal_code", "location_country")
    return rows.select(
        "id", ctx.record_id("id").alias("atlas_id"), F.col("firstname").alias("first_name"), F.col("lastname").alias("last_name"),
        *_stamps("midnight"), F.lit("active").alias("responsiveness"), F.lit("regular").alias("candidate_status"),
        *[scrub(a).alias(n) for a, n in zip(address, names)], location_locality(*address).alias("location_locality"),
        sections([(f"{label}: {CRLF}", column) for label, column in OVERVIEW], CRLF + CRLF).alias("overview"),
        F.col("createdbyid").alias("created_by_id"), F.col("lastmodifiedbyid").alias("updated_by_id"), "created_by_atlas_id",
        "updated_by_atlas_id", ctx.agency().alias("agency_id"))


def _typed_contacts(read: Read, link: str) -> DataFrame:
    """Contacts with the name of their record type, or the text that stands for it."""
    rows = fk_map(read("contact"), link, read("recordtype"), "name", "_type")
    return rows.withColumn("record_type", F.coalesce("_type", "seven20__record_type_name__c"))


def person_identities(read: Read, people: DataFrame, dupes: DataFrame, ctx: RunContext) -> DataFrame:
    rows = _typed_contacts(read, "seven20__record_type_name__c").withColumn("person_id", F.col("id"))
    rows = fk_map(survivor_key(rows, "person_id", dupes), "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    mail, candidate = email_norm("email"), F.coalesce(F.col("record_type") == "Candidate", F.lit(False))
    private = is_personal_email(mail)
    link = F.coalesce(linkedin_norm("seven20__linkedin__c"), linkedin_norm("plaunch__linkedin__c"))

    def number(column: str, own: bool) -> dict[str, Column]:
        value = phone_norm(column)
        return identity_cell("phone", F.when(F.length(value) > 5, value), F.lit("personal" if own else "corporate"), F.lit(own), column)

    long = unpivot(rows, ["person_id", "atlas_person_id", "createddate"], [
        identity_cell("email", F.when(mail.like("%@%"), mail), F.when(candidate | private, "personal").otherwise("corporate"),
                      candidate & private, "email"),
        identity_cell("linkedin", F.when(link.contains("linkedin.com"), link), F.lit(None).cast("string"), F.lit(False), "linkedin"),
        number("phone", True), number("mobilephone", True), number("otherphone", False)])
    oldest = [_ts("createddate").asc_nulls_last(), F.col("person_id").asc(), F.col("source_field").asc()]
    return identity_table(keep_first(long, ["type", "value"], oldest), ctx)


def companies(read: Read, ctx: RunContext) -> DataFrame:
    address = ("billingstreet", "billingcity", "billingstate", "billingpostalcode", "billingcountry")
    names = ("location_street_address", "location_metro", "location_region", "location_postal_code", "location_country")
    return read("account").where(not_blank("name")).select(
        "id", ctx.record_id("id").alias("atlas_id"), "name", clean_html("description").alias("summary"),
        *[scrub(a).alias(n) for a, n in zip(address, names)], location_locality(*address).alias("location_locality"),
        code_map("seven20__status__c", COMPANY_STATUS, "none").alias("relationship"), *_stamps("midnight"),
        F.col("createdbyid").alias("created_by_id"), ctx.agency().alias("agency_id"), headcount_range("numberofemployees").alias("size"))


def company_identities(read: Read, companies: DataFrame, ctx: RunContext) -> DataFrame:
    number, link = phone_norm("phone"), linkedin_norm("plaunch__linkedin__c")
    site = F.regexp_replace(F.regexp_replace(F.lower("website"), r"^https?://(www\.)?", ""), "/$", "")
    rows = unpivot(read("account").withColumn("company_id", F.col("id")), ["company_id"], [
        {"type": F.lit("phone"), "value": F.when(F.length(number) > 5, number)},
        {"type": F.lit("website"), "value": F.when(site.contains(".") & ~site.contains("linkedin.com"), site)},
        {"type": F.lit("linkedin"), "value": F.when(link.contains("linkedin.com"), link)}])
    known = companies.select("id", F.struct("atlas_id", "created_at", "updated_at").alias("c"))
    rows = fk_map(rows, "company_id", known, "c", "_c", policy="exclude")
    rows = keep_first(rows, ["type", "value"], [F.col("_c.created_at").asc_nulls_last(), F.col("company_id").asc()])
    return rows.select(ctx.record_id("company_id", "type", "value").alias("atlas_id"), "company_id",
                       F.col("_c.atlas_id").alias("atlas_company_id"), "type", "value", F.col("_c.created_at").alias("created_at"),
                       F.col("_c.updated_at").alias("updated_at"), (F.col("type") == "website").alias("is_primary"))


def company_contacts(read: Read, people: DataFrame, companies: DataFrame, dupes: DataFrame, ctx: RunContext) -> DataFrame:
    """Titled client contacts at their account; the contact id names the row, so both halves of a duplicate stay apart."""
    rows = _typed_contacts(read, "recordtypeid").where((F.col("title") != "") & (F.col("record_type") == CLIENT_CONTACT))
    rows = survivor_key(rows.withColumn("person_id", F.col("id")), "person_id", dupes)
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = fk_map(rows, "accountid", companies, "atlas_id", "atlas_company_id", policy="exclude")
    rows = fk_map(rows, "accountid", read("account"), "seven20__status__c", "_status")
    day = F.lit(ctx.midnight_iso)
    return rows.select(
        F.concat_ws("-", "id", "accountid").alias("id"), ctx.record_id("id", F.lit("-"), "accountid").alias("atlas_id"), "person_id",
        "atlas_person_id", F.col("accountid").alias("company_id"), "atlas_company_id", day.alias("created_at"), day.alias("updated_at"),
        code_map("_status", CONTACT_STATUS, "none").alias("relationship"), "title", ctx.agency().alias("agency_id"))


def _tasks(rows: DataFrame, people: DataFrame, users: DataFrame, dupes: DataFrame, ctx: RunContext) -> DataFrame:
    rows = survivor_key(rows.withColumn("person_id", F.col("whoid")), "person_id", dupes)
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = fk_map(rows, "createdbyid", users, "atlas_id", "created_by_atlas_id", default=ctx.master())
    return keep_first(rows, ["id"], [_ts("createddate").desc_nulls_last(), F.col("person_id").asc()])


def person_notes(read: Read, people: DataFrame, users: DataFrame, dupes: DataFrame, ctx: RunContext) -> DataFrame:
    """Tasks with some text that are neither mails nor meetings."""
    body = F.col("description")
    rows = read("task").where(~F.col("subject").ilike("%email%") & ~body.ilike("%to:%cc:%") & (F.length(body) > 30))
    meetings = ctx.filters.get("meetings")
    if meetings is not None:
        rows = rows.where(~F.col("subject").isin(*meetings))
    return _tasks(rows, people, users, dupes, ctx).select(
        "id", ctx.record_id("id").alias("atlas_id"), "person_id", "atlas_person_id", F.col("createdbyid").alias("created_by_id"),
        "created_by_atlas_id", strip_tags("description", " ").alias("text"), F.lit("manual").alias("type"), *_stamps())


def meetings(read: Read, people: DataFrame, users: DataFrame, dupes: DataFrame, ctx: RunContext) -> DataFrame:
    """Tasks whose subject is configured as a meeting; without a configuration there are none to tell apart."""
    rows = read("task").where((F.col("description") != "") & F.col("subject").isin(*ctx.filters.get("meetings", ())))
    return _tasks(rows, people, users, dupes, ctx).select(
        "id", ctx.record_id("id").alias("atlas_id"), "person_id", "atlas_person_id", F.col("createdbyid").alias("created_by_id"),
        "created_by_atlas_id", strip_tags("description", " ").alias("notes"), F.col("subject").alias("attribute"),
        F.lit("completed").alias("status"), F.lit("migrated meeting").alias("name"), *_stamps())


def _career(rows: DataFrame, people: DataFrame, dupes: DataFrame) -> DataFrame:
    rows = survivor_key(rows.withColumn("person_id", F.col("seven20__candidate__c")), "person_id", dupes)
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    return keep_first(rows, ["id"], [_ts("createddate").desc_nulls_last(), F.col("person_id").asc()])


def educations(read: Read, people: DataFrame, dupes: DataFrame, ctx: RunContext) -> DataFrame:
    rows = _career(_live(read, "seven20__education_history__c").where(F.col("seven20__school_name__c") != ""), people, dupes)
    ended = F.coalesce(_ts("seven20__end_date__c"), _ts("seven20__graduation_date__c"))
    return rows.select(
        "id", ctx.record_id("id").alias("atlas_id"), F.col("seven20__school_name__c").alias("name"),
        F.col("seven20__degree_subject__c").alias("field_of_study"), F.col("seven20__measure_value__c").alias("grade"),
        strip_tags("seven20__comments__c", " ").alias("description"), iso(_ts("seven20__start_date__c"), "date").alias("started_at"),
        iso(ended, "date").alias("finished_at"), *_stamps(), F.lit("migration").alias("source"), "person_id", "atlas_person_id",
        ctx.agency().alias("agency_id"))


def experiences(read: Read, people: DataFrame, companies: DataFrame, dupes: DataFrame, ctx: RunContext) -> DataFrame:
    rows = _live(read, "seven20__employment_history__c").where(
        (F.col("seven20__account__c") != "") & (F.col("seven20__job_title__c") != "") & (F.col("seven20__start_date__c") != ""))
    rows = lookup_by_text(_career(rows, people, dupes), "seven20__account__c", companies, "name",
                          {"company_id": "id", "atlas_company_id": "atlas_id"})
    return rows.select(
        "id", ctx.record_id("id").alias("atlas_id"), F.col("seven20__job_title__c").alias("title"),
        F.col("seven20__account__c").alias("company_name"), strip_tags("seven20__description__c", " ").alias("description"),
        iso(_ts("seven20__start_date__c"), "date").alias("started_at"), iso(_ts("seven20__end_date__c"), "date").alias("finished_at"),
        *_stamps(), F.lit("migration").alias("source"), "person_id", "atlas_person_id", "company_id", "atlas_company_id",
        ctx.agency().alias("agency_id"))


def projects(read: Read, companies: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    """Jobs, and leads not converted into one. A placement makes a job won; a lead older than six months is lost."""
    def owned(rows: DataFrame) -> DataFrame:
        rows = fk_map(rows, "seven20__account__c", companies, "atlas_id", "atlas_company_id", policy="exclude")
        return fk_map(rows, "ownerid", users, "atlas_id", "atlas_owner_id", default=ctx.master())

    def base(body: str) -> list[Column]:
        return [F.col("id"), ctx.record_id("id").alias("atlas_id"), F.col("name").alias("job_role"),
                strip_tags(body, " ").alias("description"), *_stamps(), F.col("seven20__account__c").alias("company_id"),
                F.col("atlas_company_id"), F.col("ownerid").alias("owner_id"), F.col("atlas_owner_id"),
                ctx.agency().alias("agency_id"), F.col("id").alias("job_number"), F.lit("project").alias("class_type")]

    jobs = exists_flag(owned(_live(read, "seven20__job__c")), "id", read("seven20__placement__c"), "seven20__job__c", "_placed")
    status = F.col("seven20__status__c")
    closed = (F.col("seven20__job_closed__c") == 1) | code_map(status, JOB_STATE).isNotNull() | F.col("_placed")
    state = F.when(F.coalesce(closed, F.lit(False)), "closed").otherwise("active")
    won = F.coalesce(status == "Placed", F.lit(False)) | F.col("_placed")
    changed, opened = iso(_ts("lastmodifieddate")), iso(_ts("createddate"))
    jobs = jobs.select(
        *base("seven20__client_description__c"), F.when(F.col("engagement_type__c") == "Part Time", "contract").otherwise(
            "full_time").alias("contract_type"), state.alias("state"),
        F.when(won, "won").when(state == "closed", "worked_lost").alias("close_reason"), F.when(state == "closed", changed).alias("closed_at"),
        F.col("target_max_base_salary__c").alias("salary"), F.col("seven20__total_value__c").alias("expected_fee"),
        location_locality("seven20__city__c", "seven20__country__c").alias("location_locality"),
        F.col("seven20__city__c").alias("location_metro"), F.col("seven20__country__c").alias("location_country"))
    leads = owned(_live(read, "seven20__job_lead__c").where(F.col("seven20__job_lead_status__c") != "Converted"))
    stale = F.coalesce(older_than_months(_ts("createddate"), ctx.today), F.lit(False))
    leads = leads.select(
        *base("seven20__advert_description__c"), F.lit("full_time").alias("contract_type"),
        F.when(stale, "closed").otherwise("lead").alias("state"), F.when(stale, "lead_lost").alias("close_reason"),
        F.when(stale, opened).alias("closed_at"))
    return keep_first(union_all(jobs, leads), ["id"], [F.col("created_at").desc_nulls_last(), F.col("state").asc()])


def project_company_contacts(read: Read, projects: DataFrame, people: DataFrame, contacts: DataFrame) -> DataFrame:
    """The hiring manager of a job or lead, with the manager's first contact row."""
    held = one_per_key(contacts, [F.col("person_id").alias("pid")], F.min(F.struct("id", "atlas_id")).alias("c"))
    rows = union_all(*[read(t).select(F.col("id").alias("project_id"), F.col("seven20__hiring_manager__c").alias("person_id"))
                       for t in ("seven20__job__c", "seven20__job_lead__c")]).where("person_id IS NOT NULL")
    rows = fk_map(rows, "project_id", projects, "atlas_id", "atlas_project_id", policy="exclude")
    rows = fk_map(rows, "person_id", held, "c", "_c", "pid", policy="exclude")
    return rows.select("project_id", "atlas_project_id", "person_id", F.col("_c.id").alias("company_contact_id"),
                       F.col("_c.atlas_id").alias("atlas_company_contact_id"))


def candidates(read: Read, projects: DataFrame, people: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(_live(read, "seven20__application__c"), "seven20__candidate__c", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = fk_map(rows, "seven20__job__c", projects, "atlas_id", "atlas_project_id", policy="exclude")
    rows = keep_first(rows, ["id"], [_ts("createddate").desc_nulls_last()])
    rows = exists_flag(rows, "id", read("seven20__placement__c"), "seven20__application__c", "_placed")
    rows = fk_map(rows, "ownerid", users, "atlas_id", "atlas_owner_id", default=ctx.master())
    stage, why = code_map("seven20__stage__c", STAGES), F.col("seven20__rejected_reason__c")
    early = F.col("seven20__stage__c").isin("Rejected", "Submitted", "Third Stage Interview", "Second Stage Interview",
                                            "First Stage Interview", "Longlist")
    status = F.when(F.col("_placed") & ~F.coalesce(early, F.lit(False)), "Hired").otherwise(F.coalesce(stage, F.lit("Added")))
    refused = code_map(why, REJECT_TYPES)
    moved = iso(_ts("seven20__date_in_stage__c"), "midnight_zulu")
    return rows.select(
        "id", ctx.record_id("id").alias("atlas_id"), *_stamps(), F.col("seven20__candidate__c").alias("person_id"), "atlas_person_id",
        F.col("seven20__job__c").alias("project_id"), "atlas_project_id", status.alias("status"),
        F.when(refused.isNotNull(), code_map(why, REJECT_REASONS, "other")).alias("rejection_reason"), refused.alias("rejection_type"),
        F.when(refused.isNotNull(), moved).alias("rejected_at"), F.when(status == "Hired", moved).alias("hired_at"),
        F.when(refused.isNotNull(), F.col("ownerid")).alias("rejected_by_id"),
        F.when(refused.isNotNull(), F.col("atlas_owner_id")).alias("atlas_rejected_by_id"), F.col("ownerid").alias("owner_id"),
        "atlas_owner_id", ctx.agency().alias("agency_id"))


def tables(read: Read, ctx: RunContext, out: Outputs, prior_users: DataFrame | None = None) -> None:
    linked = read("contact").where("seven20__related_candidate__c IS NOT NULL")
    dupes = out.add("people_dupes", survivors(
        linked.select(F.col("id").alias("contact_id"), F.col("seven20__related_candidate__c").alias("candidate_id"))).drop("in_cycle"))
    staff = out.add("users", users(read, ctx, prior_users))
    ours, firms = out.add("people", people(read, dupes, staff, ctx)), out.add("companies", companies(read, ctx))
    contacts = out.add("company_contacts", company_contacts(read, ours, firms, dupes, ctx))
    jobs = out.add("projects", projects(read, firms, staff, ctx))
    out.add("person_identities", person_identities(read, ours, dupes, ctx))
    out.add("company_identities", company_identities(read, firms, ctx))
    out.add("person_notes", person_notes(read, ours, staff, dupes, ctx))
    out.add("meetings", meetings(read, ours, staff, dupes, ctx))
    out.add("educations", educations(read, ours, dupes, ctx))
    out.add("experiences", experiences(read, ours, firms, dupes, ctx))
    out.add("project_company_contacts", project_company_contacts(read, jobs, ours, contacts))
    out.add("candidates", candidates(read, jobs, ours, staff, ctx))
