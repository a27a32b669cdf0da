"""JobAdder: one contact table, notes linked to several people, addresses typed in or parsed from a resume."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.codes import code_map, first_pattern
from ..functions.contact import linkedin_norm
from ..functions.dates import iso
from ..functions.ids import uuid_from
from ..functions.location import prefer_filled
from ..functions.names import basename
from ..functions.predicates import not_blank
from ..functions.text import clean_html, html_to_markdown, join_words, strip_tags
from ..operators.dedupe import keep_first
from ..operators.joins import exists_flag, fk_map, lookup_by_text, one_per_key
from ..operators.numbering import number_within
from ..operators.reshape import union_all
from ..plans.corrections import corrected_locations, merged_people, repaired_notes
from ..plans.identities import build_unique_owner_identities
from ..plans.notes import build_linked_notes
from ..sources.sinks import Outputs

Read = Callable[[str], DataFrame]

# What the vendor's codes mean.
COMPANY_STATUS = {5452: "client", 5455: "target"}
APPLICATION_STATUS = {
    "Submitted to client": "Presented", "Client interview 1": "Client IV", "Client interview 2": "Client IV",
    "Client Interview 3": "Client IV", "Unsuccessful": "Client IV", "Unsuccessful - Good candidate": "Client IV",
    "Unsuccessful - Skills/Experience": "Client IV", "Offered": "Offer",
}
HEAD_OFFICE = "Head Office"


def _ts(name: str) -> Column:
    return F.col(name).try_cast("timestamp")


def _stamps(style: str) -> list[Column]:
    return [iso(_ts("datecreated"), style).alias("created_at"),
            iso(F.coalesce(_ts("dateupdated"), _ts("datecreated")), style).alias("updated_at")]


def _live(read: Read, table: str) -> DataFrame:
    return read(table).where(~F.col("deleted"))


def users(read: Read, ctx: RunContext, mapping: DataFrame) -> DataFrame:
    """``mapping``: the seed of known users."""
    known = one_per_key(mapping.where(not_blank("email")), [F.trim(F.lower("email")).alias("id")], F.min("atlas_id").alias("a"))
    rows = fk_map(read("user"), F.trim(F.lower("email")), known, "a", "_known")
    return rows.select(F.col("lastlogindate").alias("updated_at"), "email", F.col("displayname").alias("name"),
                       F.col("userid").alias("id"), F.coalesce("_known", uuid_from(ctx.client, "userid")).alias("atlas_id"),
                       F.lit("active").alias("status"))


def _place(rows: DataFrame, **columns: str) -> DataFrame:
    """(contact, address struct): trimmed parts, one row per contact."""
    parts = [F.nullif(F.trim(F.col(source)), F.lit("")).alias(name) for name, source in columns.items()]
    return one_per_key(rows, [F.col("contactid").alias("id")], F.min(F.struct(*parts)).alias("p"))


def people(read: Read, users: DataFrame, ctx: RunContext) -> DataFrame:
    """Contacts. The typed-in candidate address comes first, then the one of the resume, then that of the company."""
    names = ("line1", "line2", "metro", "postcode", "region", "country")
    typed = _place(_live(read, "candidate"), line1="addressline1", line2="addressline2", metro="addresssuburb",
                   postcode="addresspostcodesearch", region="addressstate", country="addresscountry")
    parsed = _place(read("candidateresumeparsing"), line1="addressline1", line2="addressline2", metro="addressstate",
                    postcode="addresspostcode", region="addressstate", country="addresscountry")
    office = read("companyaddress").select(
        "addressid", F.struct(F.col("line1"), F.lit(None).cast("string").alias("line2"), F.col("suburb").alias("metro"),
                              F.col("postcodesearch").alias("postcode"), F.col("state").alias("region"), "country").alias("p"))
    rows = fk_map(_live(read, "contact"), "contactid", typed, "p", "_t")
    rows = fk_map(rows, "contactid", parsed, "p", "_r")
    rows = fk_map(rows, "companyaddressid", office, "p", "_o", "addressid")
    for key, name in (("createdbyuserid", "created_by_atlas_id"), ("updatedbyuserid", "updated_by_atlas_id")):
        rows = fk_map(rows, key, users, "atlas_id", name, default=ctx.master())
    is_candidate = F.col("_t").isNotNull()
    own = {n: F.coalesce(F.col(f"_t.{n}"), F.when(is_candidate, F.col(f"_r.{n}"))) for n in names}
    best = {n: prefer_filled(own[n], F.col(f"_o.{n}")) for n in names}
    line = F.trim(F.concat_ws(",", *[F.coalesce(best[n], F.lit("")) for n in ("line1", "line2", "metro", "postcode", "country")]))
    return rows.select(
        F.col("contactid").alias("id"), uuid_from(ctx.client, "contactid").alias("atlas_id"), *_stamps("millis"),
        prefer_filled("lastname").alias("last_name"), prefer_filled("firstname").alias("first_name"),
        F.col("createdbyuserid").alias("created_by_id"), "created_by_atlas_id", F.col("updatedbyuserid").alias("updated_by_id"),
        "updated_by_atlas_id", ctx.agency().alias("agency_id"), F.lit("active").alias("responsiveness"),
        F.lit("regular").alias("candidate_status"), best["country"].alias("location_country"),
        best["postcode"].alias("location_postal_code"), best["region"].alias("location_region"),
        best["line1"].alias("location_street_address"), best["line2"].alias("location_address_line_2"),
        best["metro"].alias("location_metro"), line.alias("location_locality"), is_candidate.alias("has_candidate_record"))


def companies(read: Read, ctx: RunContext) -> DataFrame:
    """Companies with their head office."""
    office = one_per_key(read("companyaddress").where(F.col("name") == HEAD_OFFICE), [F.col("companyid").alias("id")],
                         F.min(F.struct("line1", "suburb", "state", "country")).alias("a"))
    rows = fk_map(_live(read, "company"), "companyid", office, "a", "_a")
    parts = [F.col(f"_a.{c}") for c in ("line1", "suburb", "state", "country")]
    names = ("location_street_address", "location_metro", "location_region", "location_country")
    return rows.select(
        F.col("companyid").alias("id"), uuid_from(ctx.client, "companyid").alias("atlas_id"), *_stamps("millis"),
        F.trim("name").alias("name"), *[p.alias(n) for p, n in zip(parts, names)], join_words(*parts).alias("location_locality"),
        code_map(F.col("statusid").cast("int"), COMPANY_STATUS, "target").alias("relationship"))


def company_identities(read: Read, companies: DataFrame, ctx: RunContext) -> DataFrame:
    """Profiles of the company and web pages of its addresses, each value once per type."""
    def profile(column: str, kind: str, pattern: str, host: str) -> DataFrame:
        return _live(read, "company").where(not_blank(column)).select(
            F.col("companyid").alias("company_id"), F.lit(kind).alias("type"),
            F.regexp_replace(column, pattern, host).alias("value"), *_stamps("millis"), _ts("dateupdated").alias("_changed"))

    sites = read("companyaddress").where(not_blank("url")).select(
        F.col("companyid").alias("company_id"), F.lit("website").alias("type"), linkedin_norm("url").alias("value"),
        F.lit(ctx.now_iso).alias("created_at"), F.lit(ctx.now_iso).alias("updated_at"))
    rows = union_all(profile("twitterurl", "twitter", r"^.*twitter\.com", "x.com"),
                     profile("linkedinurl", "linkedin", r"^.*linkedin\.com", "linkedin.com"), sites)
    rows = keep_first(rows, ["type", "value"], [F.col("_changed").desc_nulls_last(), F.col("company_id").asc()])
    rows = fk_map(rows, "company_id", companies, "atlas_id", "atlas_company_id", policy="exclude")
    return rows.select(uuid_from(ctx.client, "value").alias("atlas_id"), "value", "created_at", "updated_at", "type",
                       ctx.agency().alias("agency_id"), "company_id", "atlas_company_id", (F.col("type") == "website").alias("is_primary"))


def company_contacts(read: Read, people: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    rows = _live(read, "contact").where(~F.col("iscandidateonly"))
    rows = fk_map(rows, "contactid", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = fk_map(rows, "companyid", companies, "atlas_id", "atlas_company_id", policy="exclude")
    return rows.select(
        F.col("contactid").alias("id"), F.col("contactid").alias("person_id"),
        uuid_from(ctx.client, "contactid", F.lit("companycontact"), F.lit(ctx.client)).alias("atlas_id"), *_stamps("millis"),
        ctx.agency().alias("agency_id"), "atlas_person_id", F.col("companyid").alias("company_id"), "atlas_company_id",
        F.lit("prospect").alias("relationship"), F.coalesce(prefer_filled("position"), F.lit("Contact")).alias("title"))


def company_notes(read: Read, companies: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    """A note on several companies becomes one row per company, numbered within the note."""
    links = read("companynote").select("noteid", F.col("companyid").alias("company_id")).distinct()
    numbered = number_within(links, ["noteid"], ["company_id"], "_n")
    texts = _live(read, "note").select("noteid", clean_html("text").alias("text"), *_stamps("seconds"),
                                       F.col("createdbyuserid").alias("created_by_id"), F.col("updatedbyuserid").alias("updated_by_id"))
    rows = numbered.join(texts, "noteid").where(not_blank("text"))
    rows = fk_map(rows, "company_id", companies, "atlas_id", "atlas_company_id", policy="exclude")
    for key, name in (("created_by_id", "created_by_atlas_id"), ("updated_by_id", "updated_by_atlas_id")):
        rows = fk_map(rows, key, users, "atlas_id", name, default=ctx.master())
    return rows.select(
        F.concat_ws("_", "noteid", "_n").alias("id"), uuid_from(ctx.client, "atlas_company_id", "noteid").alias("atlas_id"), "text",
        "created_at", "updated_at", "created_by_id", "updated_by_id", "created_by_atlas_id", "updated_by_atlas_id",
        F.lit("manual").alias("type"), "company_id", "atlas_company_id")


def experiences(read: Read, people: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    rows = read("candidateemploymenthistory").where(F.col("startdate").isNotNull() & not_blank("employer") & not_blank("position"))
    rows = fk_map(rows, "contactid", people, "atlas_id", "atlas_person_id")
    rows = lookup_by_text(rows, "employer", companies, "name", {"company_id": "id", "atlas_company_id": "atlas_id"})
    return rows.select(
        F.col("employmentid").alias("id"), uuid_from(ctx.client, "employmentid", F.lit(ctx.agency_id)).alias("atlas_id"),
        ctx.master().alias("created_by_id"), ctx.agency().alias("agency_id"), F.col("contactid").alias("person_id"), "atlas_person_id",
        F.trim("employer").alias("company_name"), "company_id", "atlas_company_id",
        F.left(F.col("startdate").cast("string"), F.lit(10)).alias("started_at"),
        F.left(F.col("enddate").cast("string"), F.lit(10)).alias("finished_at"), html_to_markdown("description").alias("description"),
        F.col("position").alias("title"), F.lit("migration").alias("source"))


def educations(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(read("candidateeducation").where(not_blank("institution")), "contactid", people, "atlas_id", "atlas_person_id")
    now = F.lit(ctx.now_iso)
    return rows.select(
        F.col("educationid").alias("id"), uuid_from(ctx.client, "educationid", F.lit(ctx.client)).alias("atlas_id"),
        F.left(F.col("enddate").cast("string"), F.lit(10)).alias("finished_at"), F.col("course").alias("field_of_study"),
        F.col("institution").alias("name"), F.lit("migration").alias("source"), F.col("contactid").alias("person_id"),
        "atlas_person_id", now.alias("created_at"), now.alias("updated_at"))


def projects(read: Read, companies: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    """Closed orders with a placement are won, the others worked and lost."""
    rows = fk_map(read("joborder"), "companyid", companies, "atlas_id", "atlas_company_id", policy="exclude")
    rows = fk_map(rows, "locationid", read("location"), "name", "_place", "locationid")
    rows = fk_map(rows, "owneruserid", users, "atlas_id", "atlas_owner_id", default=ctx.master())
    rows = exists_flag(rows, "joborderid", read("placement"), "joborderid", "_placed")
    closed = F.col("dateclosed").isNotNull()
    return rows.select(
        F.col("joborderid").alias("id"), uuid_from(ctx.client, "joborderid", F.lit(ctx.client)).alias("atlas_id"), *_stamps("midnight"),
        strip_tags("jobdescription", " ").alias("job_description"), F.col("jobtitle").alias("job_role"),
        F.when(closed, "closed").otherwise("active").alias("state"),
        F.when(closed & F.col("_placed"), "won").when(closed, "worked_lost").alias("close_reason"),
        iso(_ts("dateclosed"), "midnight").alias("closed_at"), F.lit("full_time").alias("contract_type"),
        F.col("_place").alias("location_locality"), F.col("numberofjobs").alias("hire_target"), F.col("companyid").alias("company_id"),
        "atlas_company_id", F.when(closed, ctx.master()).alias("closed_by_id"), F.col("owneruserid").alias("owner_id"), "atlas_owner_id",
        F.lit(False).alias("public"), F.lit("project").alias("class_type"),
        F.concat(F.col("feerate").cast("string"), F.lit("%")).alias("fee_terms"), F.col("feeamount").alias("expected_fee"),
        F.col("feecurrencycode").alias("expected_fee_currency"), F.col("joborderid").alias("job_number"))


def project_company_contacts(read: Read, projects: DataFrame, contacts: DataFrame) -> DataFrame:
    rows = fk_map(read("joborder"), "joborderid", projects, "atlas_id", "atlas_project_id", policy="exclude")
    rows = fk_map(rows, "contactid", contacts, "atlas_id", "atlas_company_contact_id", "person_id", policy="exclude")
    return rows.select(F.col("joborderid").alias("project_id"), "atlas_project_id", F.col("contactid").alias("company_contact_id"),
                       "atlas_company_contact_id")


def candidates(read: Read, projects: DataFrame, people: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    """The newest application per project and person."""
    rows = fk_map(read("jobapplication"), "joborderid", projects, "atlas_id", "atlas_project_id", policy="exclude")
    rows = fk_map(rows, "contactid", people, "atlas_id", "atlas_person_id", policy="exclude")
    day = [F.to_date(F.coalesce(_ts("dateupdated"), _ts("datecreated"))).desc_nulls_last(), F.to_date(_ts("datecreated")).desc_nulls_last()]
    rows = keep_first(rows, ["joborderid", "contactid"], [*day, F.col("applicationid").desc()])
    states = read("jobapplicationstatus").select("statusid", F.struct("name", "rejected").alias("s"))
    rows = fk_map(rows, "statusid", states, "s", "_s", "statusid")
    rows = fk_map(rows, "owneruserid", users, "atlas_id", "atlas_owner_id", default=ctx.master())
    name, refused = F.col("_s.name"), F.coalesce(F.col("_s.rejected"), F.lit(False))
    return rows.select(
        F.col("applicationid").alias("id"), uuid_from(ctx.client, "applicationid", F.lit(ctx.client)).alias("atlas_id"), *_stamps("midnight"),
        F.col("joborderid").alias("project_id"), "atlas_project_id", F.col("contactid").alias("person_id"), "atlas_person_id",
        F.col("owneruserid").alias("owner_id"), "atlas_owner_id", F.lit("Candidate").alias("class_type"),
        F.coalesce(code_map(name, APPLICATION_STATUS), first_pattern(name, [("%placed%", "Hired")], "Added")).alias("status"),
        F.when(refused, iso(_ts("dateupdated"), "midnight")).alias("rejected_at"), F.when(refused, "by_us").alias("rejection_type"),
        F.when(refused, "other").alias("rejection_reason"), F.when(refused, F.col("atlas_owner_id")).alias("atlas_rejected_by_id"))


def resumes(read: Read, people: DataFrame) -> DataFrame:
    """Stored resume files of candidates."""
    rows = read("candidateattachment").where(F.col("type") == "Resume").select(F.col("attachmentid"), F.col("contactid").alias("person_id"))
    stored = read("attachment").select("candidateattachmentid", F.struct("storagename", "filename").alias("f"))
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id")
    rows = fk_map(rows, "attachmentid", stored, "f", "_f", "candidateattachmentid")
    return rows.select("attachmentid", "person_id", "atlas_person_id", F.col("_f.storagename").alias("file_id"),
                       basename("_f.storagename").alias("adjusted_file_id"), F.col("_f.filename").alias("filename"))


def corrections(read: Read, people: DataFrame, users: DataFrame, ctx: RunContext, out: Outputs) -> None:
    """What a second pass repairs: merged people, locations, contact notes."""
    merged = read("contact").select(F.col("contactid").alias("id"), F.col("previouscontactid").alias("previous_id"),
                                    F.col("linkedinurl").alias("linkedin"), "email")
    out.add("correction_mergepeople", merged_people(merged, people))
    address = [F.col("addressline1").alias("line1"), F.col("addressline2").alias("line2")]
    parsed = read("candidateresumeparsing").select(
        F.col("contactid").alias("person_id"), F.col("addresspostcode").alias("postcode"), *address,
        F.col("addressstate").alias("state"), F.col("addresscountry").alias("country"))
    entered = read("candidate").select(
        F.col("contactid").alias("person_id"), F.col("addresspostcode").alias("postcode"), *address,
        F.col("addresssuburb").alias("state"), F.col("addresscountrycode").alias("country"))
    out.add("correction_peoplelocation", corrected_locations(people, parsed, entered))
    known = read("contact").select(F.col("contactid").alias("person_id"))
    links = read("contactnote").select("noteid", F.col("contactid").alias("person_id")).join(known, "person_id", "left_semi")
    texts = read("note").where((F.col("source") == "Note") & F.col("summary").isNotNull()).select(
        "noteid", F.col("createdbyuserid").alias("created_by_id"), "text", _ts("datecreated").alias("created_at"))
    out.add("fix_contact_notes", repaired_notes(links.join(texts, "noteid").withColumnRenamed("noteid", "id"), people, users, ctx))


def tables(read: Read, ctx: RunContext, out: Outputs, user_mapping: DataFrame) -> None:
    staff = out.add("users", users(read, ctx, user_mapping))
    ours, firms = out.add("people", people(read, staff, ctx)), out.add("companies", companies(read, ctx))
    contacts = out.add("company_contacts", company_contacts(read, ours, firms, ctx))
    jobs = out.add("projects", projects(read, firms, staff, ctx))
    raw = _live(read, "contact").select(F.col("contactid").alias("person_id"), "email", "phone", "mobile", F.col("linkedinurl").alias("linkedin"))
    out.add("person_identities", build_unique_owner_identities(raw, ours, ctx))
    out.add("company_identities", company_identities(read, firms, ctx))
    links = [read(t).select(F.col("noteid").alias("note_id"), F.col("contactid").alias("person_id")) for t in ("contactnote", "candidatenote")]
    texts = read("note").select(F.col("noteid").alias("id"), F.col("createdbyuserid").alias("created_by_id"),
                                html_to_markdown("text").alias("text"), F.col("type").alias("kind"), _ts("datecreated").alias("created_at"))
    out.add("person_notes", build_linked_notes(links, texts, ours, staff, ctx))
    out.add("company_notes", company_notes(read, firms, staff, ctx))
    out.add("experiences", experiences(read, ours, firms, ctx))
    out.add("educations", educations(read, ours, ctx))
    out.add("project_company_contacts", project_company_contacts(read, jobs, contacts))
    out.add("candidates", candidates(read, jobs, ours, staff, ctx))
    out.add("mapping_resume", resumes(read, ours))
    corrections(read, ours, staff, ctx, out)
