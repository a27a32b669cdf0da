"""Vincere: candidates and contacts linked by an external id, a stage date per step of a candidacy."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.codes import code_map, first_pattern, stage_from_dates
from ..functions.contact import dummy_email, phone_norm, profile_url, strip_host
from ..functions.dates import iso, latest_of
from ..functions.ids import uuid_from
from ..functions.names import file_extension
from ..functions.predicates import not_blank
from ..functions.text import clean_html, strip_tags, trim_chars
from ..operators.dedupe import keep_first, priority
from ..operators.joins import fk_map, lookup_by_text, match_id_or_external, one_per_key
from ..operators.numbering import number_within
from ..operators.reshape import union_all, union_distinct, unpivot
from ..plans.identities import CLASS_TYPES, two_stage_identities
from ..sources.sinks import Outputs

Read = Callable[[str], DataFrame]

INTERVIEWS = tuple(f"interview{i}_date" for i in range(1, 6))
# The stages of a candidacy, furthest first, and what the job statuses mean.
STAGES = [("Hired", ["hire_date"]), ("Offer", ["offer_date"]), ("Client IV", list(INTERVIEWS)), ("Presented", ["sent_date"])]
JOB_STATES = [("%open%", "active"), ("%on%hold%", "on_hold"), ("%closed%", "closed"), ("%cancelled%", "closed")]
POOL = "talent pool"
UNWANTED_MAIL = "vincere\\.io|no_email"


def _id(ctx: RunContext, *parts: Column | str) -> Column:
    return uuid_from(ctx.client, *parts).alias("atlas_id")


def _ts(name: str) -> Column:
    return F.col(name).try_cast("timestamp")


def _live(read: Read, table: str) -> DataFrame:
    rows = read(table).where("deleted_timestamp IS NULL")
    return rows.where("deleted_reason IS NULL") if table == "public_candidate" else rows


def users(read: Read, ctx: RunContext, mapping: DataFrame) -> DataFrame:
    staff = read("public_user_account").where("deleted_timestamp IS NULL").where(~F.col("email").contains("vincere"))
    known = one_per_key(mapping.where("email IS NOT NULL"), [F.col("email").alias("id")],
                        F.min(F.struct("atlas_id", "name")).alias("p"))
    rows = fk_map(staff, "email", known, "p", "_p")
    return rows.select("id", F.coalesce("_p.atlas_id", uuid_from(ctx.client, "email", "name")).alias("atlas_id"),
                       F.coalesce("_p.name", "name").alias("name"),
                       dummy_email("email", "name", ctx.domain).alias("email"), F.lit("active").alias("status"))


def people(read: Read, ctx: RunContext) -> DataFrame:
    """Live candidates, then the contacts that are no candidate. The smallest contact of an external id is linked."""
    candidates, contacts = _live(read, "public_candidate"), _live(read, "public_contact")
    linked = one_per_key(contacts.where("external_id IS NOT NULL"), [F.col("external_id").alias("x")],
                         F.min("id").alias("contact"))
    known = one_per_key(candidates.where("external_id IS NOT NULL"), [F.col("external_id").alias("x")],
                        F.min("id").alias("candidate"))
    place = one_per_key(read("public_contact_location"), [F.col("contact_id")], F.min("company_location_id").alias("place"))
    named = read("public_company_location").select(
        "id", trim_chars(F.coalesce("address", "location_name", "country", "address_line1"), ",. ").alias("line"))

    def side(rows: DataFrame, key: Column, seed: Column, where: Column, line: Column) -> DataFrame:
        return rows.select(
            key.alias("id"), _id(ctx, seed), "first_name", "last_name", F.col("external_id").alias("link_id"),
            F.col("user_account_id").alias("created_by_id"), F.col("user_account_id").alias("updated_by_id"),
            iso(F.date_trunc("day", _ts("insert_timestamp"))).alias("created_at"), "_contact",
            clean_html("note_backup").alias("overview"), where.alias("_place"), line.alias("_line"))

    ours = fk_map(candidates, "external_id", linked, "contact", "_contact", "x")
    ours = side(ours, F.col("id").cast("string"), F.concat(F.lit(ctx.agency_id), F.col("id").cast("string"), F.coalesce("email", F.lit(""))),
                F.coalesce("current_location_id", "personal_location_id"), F.lit(None).cast("string"))
    rest = fk_map(contacts, "external_id", known, "candidate", "_candidate", "x").where("_candidate IS NULL")
    rest = fk_map(fk_map(rest, "id", place, "place", "_at", "contact_id"), "_at", named, "line", "_line")
    rest = side(rest.withColumn("_contact", F.col("id")), F.concat(F.lit("cont"), F.col("id").cast("string")),
                F.concat(F.lit(ctx.client), F.col("id").cast("string"), F.coalesce("email", F.lit(""))),
                F.col("current_location_id"), F.col("_line"))
    city = read("public_common_location").select("id", F.struct(trim_chars("city", ",. ").alias("city"),
                                                                trim_chars("country", ",. ").alias("country")).alias("p"))
    rows = fk_map(union_all(ours, rest), "_place", city, "p", "_p")
    parts = [F.nullif(c, F.lit("")) for c in (F.col("_line"), F.col("_p.city"), F.col("_p.country"))]
    return rows.select(
        "id", "atlas_id", "first_name", "last_name", "created_by_id", "updated_by_id", ctx.agency().alias("agency_id"),
        "created_at", F.lit(ctx.now_iso).alias("updated_at"), F.lit("active").alias("responsiveness"),
        F.lit("regular").alias("candidate_status"), ctx.master().alias("created_by_atlas_id"),
        ctx.master().alias("updated_by_atlas_id"), "link_id", F.col("_contact").alias("company_contact_id"),
        trim_chars(F.concat_ws(", ", *parts), ", ").alias("location_locality"), "overview")


def contact_owners(read: Read, people: DataFrame) -> DataFrame:
    """(contact, person): by the person's own contact id, or by the external id for people without one."""
    by_contact = one_per_key(people.where("company_contact_id IS NOT NULL"), [F.col("company_contact_id").alias("cid")],
                             F.min("id").alias("person"))
    by_link = people.where("company_contact_id IS NULL AND link_id IS NOT NULL").select(F.col("link_id").alias("lid"), "id")
    rows = fk_map(_live(read, "public_contact").select("id", "external_id"), "id", by_contact, "person", "_own", "cid")
    direct = rows.where("_own IS NOT NULL").select("id", F.col("_own").alias("person_id"))
    matched = match_id_or_external(rows.where("_own IS NULL"), "id", "_own", "external_id", by_link, "id", "lid")
    return direct.unionByName(matched.select("id", F.col("match_id").alias("person_id")))


def person_identities(read: Read, people: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    """E-mails, profiles and numbers of both sides, unique per person and then over all people."""
    def mail(column: str, scope: str) -> dict[str, Column]:
        value = F.lower(F.trim(column))
        fine = value.contains("@") & ~value.rlike(UNWANTED_MAIL)
        return {"type": F.lit("email"), "value": F.when(fine, value), "scope": F.lit(scope)}

    def number(column: str, scope: str) -> dict[str, Column]:
        value = phone_norm(column)
        return {"type": F.lit("phone"), "value": F.when(F.length(value) >= 8, value), "scope": F.lit(scope)}

    def profile(column: str, scope: str) -> dict[str, Column]:
        value = profile_url(column)
        return {"type": F.lit("linkedin"), "value": F.when(value.contains("linkedin.com/in/"), value), "scope": F.lit(scope)}

    keep = ["person_id", "user_account_id"]
    ours = _live(read, "public_candidate").withColumn("person_id", F.col("id").cast("string"))
    theirs = fk_map(_live(read, "public_contact"), "id", contact_owners(read, people), "person_id", "person_id", policy="exclude")
    rows = union_all(
        unpivot(ours, keep, [mail("email", "personal"), mail("email2", "personal"), mail("work_email", "personal"),
                             profile("linked_in_profile", "personal"), number("phone", "personal"),
                             number("phone2", "personal"), number("work_phone", "personal")]),
        unpivot(theirs, keep, [mail("email", "corporate"), mail("personal_email", "corporate"),
                               profile("linkedin", "corporate"), number("phone", "corporate")]))
    rows = fk_map(two_stage_identities(rows), "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = fk_map(rows, "user_account_id", users, "atlas_id", "created_by_atlas_id", default=ctx.master())
    return rows.select(
        _id(ctx, "person_id", "value", "type"), "value", "favourite", F.lit(True).alias("active"), "type",
        F.col("scope").alias("identity_type_type"), code_map("type", CLASS_TYPES).alias("class_type"),
        ctx.agency().alias("agency_id"), "person_id", F.lit("migration").alias("source"),
        F.col("user_account_id").alias("created_by_id"), "created_by_atlas_id", F.lit(False).alias("hidden"),
        F.lit(True).alias("verified"), "atlas_person_id")


def companies(read: Read, ctx: RunContext) -> DataFrame:
    """Named companies with the place of their headquarters."""
    unsaid = F.regexp_replace("location_name", r"(\s*,?\s*[Nn]one\s+[Ss]pecified)+", "")
    place = read("public_company_location").where(F.col("location_types_array").ilike("%HEADQUARTER%")).select(
        "company_id", F.struct(F.nullif(trim_chars(unsaid, ",. "), F.lit("")).alias("name"), "city", "country", "state").alias("l"))
    held = one_per_key(place, [F.col("company_id")], F.min("l").alias("l"))
    rows = fk_map(read("public_company").where(not_blank("name")), "id", held, "l", "_l", "company_id")
    return rows.select(
        "id", _id(ctx, "id"), F.trim("name").alias("name"), iso(_ts("insert_timestamp")).alias("created_at"),
        F.lit(ctx.now_iso).alias("updated_at"), F.coalesce("_l.name", "_l.city", "_l.country", "_l.state").alias("location_locality"),
        F.col("_l.city").alias("location_metro"), F.col("_l.country").alias("location_country"),
        F.col("_l.state").alias("location_region"), ctx.agency().alias("agency_id"), F.lit("target").alias("relationship"))


def company_identities(read: Read, companies: DataFrame, ctx: RunContext) -> DataFrame:
    raw = read("public_company").withColumn("company_id", F.col("id"))
    rows = unpivot(raw, ["company_id"], [
        {"type": F.lit("website"), "value": F.when(not_blank("website"), strip_host("website")), "key": F.col("website")},
        {"type": F.lit("linkedin"), "value": F.when(F.col("url_linkedin").contains("linkedin.com"), strip_host("url_linkedin")),
         "key": F.col("url_linkedin")}])
    rows = keep_first(rows, ["value"], [priority("type", ("website",)), F.col("company_id").asc()])
    rows = fk_map(rows, "company_id", companies, "atlas_id", "atlas_company_id", policy="exclude")
    return rows.select("value", ctx.record_id("key").alias("atlas_id"), F.lit(ctx.now_iso).alias("created_at"),
                       F.lit(ctx.now_iso).alias("updated_at"), "type", "company_id", ctx.agency().alias("agency_id"),
                       (F.col("type") == "website").alias("is_primary"), "atlas_company_id")


def _person_of_contact(people: DataFrame) -> DataFrame:
    return one_per_key(people.where("company_contact_id IS NOT NULL"), [F.col("company_contact_id").alias("cid")],
                       F.min(F.struct("id", "atlas_id")).alias("p"))


def company_contacts(read: Read, people: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(_live(read, "public_contact"), "id", _person_of_contact(people), "p", "_p", "cid", policy="exclude")
    rows = fk_map(rows, "company_id", companies, "atlas_id", "atlas_company_id", policy="exclude")
    return rows.select(
        "id", F.col("_p.id").alias("person_id"), _id(ctx, F.lit("vincere_company_contact_"), F.lit(ctx.client), "id"),
        iso(_ts("insert_timestamp")).alias("created_at"), F.lit(ctx.now_iso).alias("updated_at"),
        ctx.agency().alias("agency_id"), "company_id", F.lit("prospect").alias("contact_role"),
        F.coalesce("job_title", F.lit("contact")).alias("title"), F.col("_p.atlas_id").alias("atlas_person_id"),
        "atlas_company_id", F.lit("prospect").alias("relationship"))


def experiences(read: Read, people: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    rows = read("public_candidate_work_history").select(
        "id", F.col("candidate_id").cast("string").alias("person_id"),
        F.col("start_date").try_cast("date").cast("string").alias("started_at"),
        F.col("end_date").try_cast("date").cast("string").alias("finished_at"), F.col("job_title").alias("title"),
        F.col("company").alias("description"), F.col("current_employer").alias("company_name"))
    rows = rows.where(not_blank("company_name") & not_blank("title") & F.col("started_at").isNotNull())
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = lookup_by_text(rows, "company_name", companies, "name", {"company_id": "id", "atlas_company_id": "atlas_id"})
    rows = keep_first(rows, ["id"], [F.col("atlas_company_id").isNull().asc(), F.col("started_at").asc()])
    return rows.withColumns({
        "atlas_id": uuid_from(ctx.client, F.lit("vincere_experience_"), F.lit(ctx.client), "id"),
        "agency_id": ctx.agency(), "created_by_id": ctx.master(), "source": F.lit("migration"),
        "created_at": F.lit(ctx.now_iso)})


def person_notes(read: Read, people: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    """Comments of some length on a candidate, and on a contact."""
    raw = read("public_activity").where(F.col("category") == "comment")
    rows = unpivot(raw, ["id", "candidate_id", "contact_id", "user_account_id", "insert_timestamp"],
                   [{"value": strip_tags("content", " ")}]).where(F.length(F.trim("value")) > 10)
    rows = rows.withColumn("_candidate", F.col("candidate_id").cast("string"))
    own = people.select("id", F.struct("id", "atlas_id").alias("p"))
    parts = union_all(
        fk_map(rows.where("candidate_id IS NOT NULL"), "_candidate", own, "p", "_p", policy="exclude"),
        fk_map(rows.where("contact_id IS NOT NULL"), "contact_id", _person_of_contact(people), "p", "_p", "cid", policy="exclude"))
    parts = fk_map(parts, "user_account_id", users, "atlas_id", "created_by_atlas_id", default=ctx.master())
    one = keep_first(parts, ["id"], [F.col("_p.id").asc()])
    day = iso(_ts("insert_timestamp"), "midnight")
    return one.select(
        uuid_from(ctx.client, "id").alias("id"), _id(ctx, "id"), F.col("value").alias("text"),
        F.col("user_account_id").alias("created_by_id"), "created_by_atlas_id", F.col("_p.id").alias("person_id"),
        F.lit("manual").alias("type"), day.alias("created_at"), day.alias("updated_at"),
        F.col("_p.atlas_id").alias("atlas_person_id"), ctx.agency().alias("agency_id"), F.lit("migration").alias("source"))


def projects(read: Read, companies: DataFrame, users: DataFrame, ctx: RunContext, closed_before: str | None) -> DataFrame:
    """A hire closes a project as won; projects opened before ``closed_before`` arrive closed as cancelled."""
    hired = one_per_key(read("public_position_candidate").where("hire_date IS NOT NULL"),
                        [F.col("position_description_id").alias("pid")], F.min(_ts("hire_date")).alias("at"))
    rows = fk_map(read("public_position_description"), "company_id", companies, "atlas_id", "atlas_company_id")
    rows = fk_map(rows, "active", read("public_job_status"), "name", "_status")
    rows = fk_map(rows, "creator_account_id", users, "atlas_id", "atlas_owner_id", default=ctx.master())
    rows = fk_map(rows, "id", hired, "at", "_hired", "pid")
    opened, changed = iso(_ts("insert_timestamp")), iso(F.coalesce(_ts("updated_timestamp"), _ts("insert_timestamp")))
    won = F.col("_hired").isNotNull()
    old = opened < F.lit(closed_before) if closed_before else F.lit(False)
    told = F.coalesce(F.col("_status").rlike("(?i)closed|cancelled"), F.lit(False))
    dropped = F.coalesce(F.col("active").isin(2, 3), F.lit(False))
    return rows.select(
        "id", _id(ctx, F.lit("vincere_project_"), F.lit(ctx.client), "id"), F.col("name").alias("job_role"),
        opened.alias("created_at"), changed.alias("updated_at"), clean_html("public_description").alias("job_description"),
        F.col("_status").alias("original_state"),
        F.when(won | old, "closed").otherwise(first_pattern("_status", JOB_STATES, "active")).alias("state"),
        F.when(won, "won").when(old | told | dropped, "cancelled").alias("close_reason"),
        F.when(won | old | told | dropped, changed).alias("closed_at"), F.lit(1).alias("hire_target"),
        ctx.agency().alias("agency_id"), "company_id", "atlas_company_id",
        F.col("creator_account_id").cast("string").alias("owner_id"), "atlas_owner_id", F.lit(False).alias("public"),
        F.col("forecast_annual_fee").alias("expected_fee"), F.lit("GBP").alias("expected_fee_currency"),
        F.lit("project").alias("class_type"), F.col("id").alias("job_number"))


def project_company_contacts(read: Read, projects: DataFrame, contacts: DataFrame) -> DataFrame:
    live = _live(read, "public_contact").select(F.col("id").alias("cid"), F.lit(True).alias("ok"))
    rows = fk_map(read("public_position_description"), "contact_id", live, "ok", "_ok", "cid", policy="exclude")
    rows = fk_map(rows, "id", projects, "atlas_id", "atlas_project_id")
    rows = fk_map(rows, "contact_id", contacts, "atlas_id", "atlas_company_contact_id")
    return rows.select(F.col("id").alias("project_id"), "atlas_project_id",
                       F.col("contact_id").cast("string").alias("company_contact_id"), "atlas_company_contact_id")


def candidates(read: Read, people: DataFrame, projects: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    """The latest candidacy per project and person, by its last stage date."""
    dates = [_ts(c) for c in ("associated_date", "applied_date", "sent_date", *INTERVIEWS, "offer_date", "hire_date")]
    rows = read("public_position_candidate").withColumn("_event", latest_of(*dates))
    rows = keep_first(rows, ["position_description_id", "candidate_id"], [
        F.col("_event").desc_nulls_first(), _ts("modified_date").desc_nulls_last(),
        _ts("insert_timestamp").desc_nulls_last(), F.col("id").asc()])
    rows = rows.withColumn("person_id", F.col("candidate_id").cast("string"))
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = fk_map(rows, "position_description_id", projects, "atlas_id", "atlas_project_id")
    rows = fk_map(rows, "created_by", users, "atlas_id", "atlas_owner_id", default=ctx.master())
    refused = F.col("rejected_date").isNotNull()
    return rows.select(
        iso(_ts("insert_timestamp")).alias("created_at"), iso(_ts("modified_date")).alias("updated_at"), "id",
        _id(ctx, F.lit("vincere_candidate_"), F.lit(ctx.client), "id", F.lit("_"), "candidate_id"),
        ctx.agency().alias("agency_id"), F.col("position_description_id").alias("project_id"), "atlas_project_id",
        "person_id", "atlas_person_id", F.col("created_by").cast("string").alias("owner_id"), "atlas_owner_id",
        ctx.master().alias("created_by_atlas_id"), F.lit("Candidate").alias("class_type"),
        stage_from_dates(STAGES, "Added").alias("status"),
        iso(F.date_trunc("day", _ts("rejected_date")), "midnight").alias("rejected_at"),
        F.when(refused, "by_us").alias("rejection_type"), F.when(refused, "other").alias("rejection_reason"))


def talent_pools(read: Read, ctx: RunContext) -> tuple[DataFrame, DataFrame]:
    """The one attribute and its options: a pool per candidate group."""
    day = {"created_at": F.lit(ctx.midnight_iso), "updated_at": F.lit(ctx.midnight_iso), "agency_id": ctx.agency()}
    groups = read("candidate_group").select("id", F.col("name").alias("value"))
    pool = uuid_from(ctx.client, F.lit(ctx.agency_id), F.lit(POOL))
    attribute = groups.sparkSession.range(1).select(
        F.lit("1").alias("id"), pool.alias("atlas_id"), F.lit(POOL).alias("name"), F.lit(True).alias("multiple_values"),
        F.lit("person").alias("of"), F.lit(False).alias("ai"), F.lit("options").alias("type")).withColumns(day)
    options = number_within(groups, [], ["value", "id"]).withColumns({
        "atlas_attribute_id": pool, "atlas_id": uuid_from(ctx.client, F.lit("atlas_attribute_id"), F.lit(ctx.agency_id), "id"), **day})
    return attribute, options


def expertise_values(read: Read, people: DataFrame, options: DataFrame, ctx: RunContext) -> DataFrame:
    """Functional and sub-functional expertise of a candidate as attribute values."""
    held = read("candidate_functional_expertise")
    person = F.col("candidate_id").cast("string").alias("person_id")
    rows = union_distinct(held.select(person, F.col("functional_expertise_id").alias("option_id")),
                          held.where("sub_functional_expertise_id IS NOT NULL").select(
                              person, F.col("sub_functional_expertise_id").alias("option_id")))
    choice = options.select("id", F.struct("atlas_attribute_id", "atlas_id").alias("o"))
    rows = fk_map(rows, "option_id", choice, "o", "_o", policy="exclude")
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    return rows.select(
        _id(ctx, "atlas_person_id", "_o.atlas_attribute_id", "_o.atlas_id"), "person_id", "atlas_person_id",
        F.col("_o.atlas_attribute_id").alias("atlas_custom_attribute_id"), F.col("_o.atlas_id").alias("atlas_option_id"),
        F.lit(ctx.midnight_iso).alias("created_at"), F.lit(ctx.midnight_iso).alias("updated_at"))


def people_overview(read: Read, people: DataFrame) -> DataFrame:
    """The profile text of every person kept from a candidate who has one."""
    noted = read("public_candidate").where(not_blank("note_backup"))
    rows = noted.select(F.col("id").cast("string").alias("person_id"), clean_html("note_backup").alias("overview"))
    return fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")


def files(read: Read, people: DataFrame) -> DataFrame:
    """Documents of candidates, also of those that were not kept."""
    rows = read("public_candidate_document").where("candidate_id IS NOT NULL")
    rows = rows.withColumn("person_id", F.col("candidate_id").cast("string"))
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id")
    stamp = F.date_format(_ts("insert_timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return rows.select(
        "id", uuid_from("", "id").alias("atlas_id"), F.col("uploaded_filename").alias("file_name"),
        file_extension("uploaded_filename").alias("ext"), F.col("filesize").alias("size"), F.lit("other").alias("type"),
        stamp.alias("created_at"), stamp.alias("updated_at"), stamp.alias("received_at"),
        F.col("saved_filename").alias("path"), "person_id", "atlas_person_id")


def tables(read: Read, ctx: RunContext, out: Outputs, user_mapping: DataFrame, closed_before: str | None = None) -> None:
    """``user_mapping``: the seed of known users."""
    staff = out.add("users", users(read, ctx, user_mapping))
    ours, firms = out.add("people", people(read, ctx)), out.add("companies", companies(read, ctx))
    jobs = out.add("projects", projects(read, firms, staff, ctx, closed_before))
    contacts = out.add("company_contacts", company_contacts(read, ours, firms, ctx))
    attribute, options = talent_pools(read, ctx)
    out.add("custom_attributes", attribute)
    options = out.add("custom_attribute_options", options)
    out.add("person_custom_attribute_values", expertise_values(read, ours, options, ctx))
    out.add("people_overview", people_overview(read, ours))
    out.add("files", files(read, ours))
    out.add("person_identities", person_identities(read, ours, staff, ctx))
    out.add("company_identities", company_identities(read, firms, ctx))
    out.add("experiences", experiences(read, ours, firms, ctx))
    out.add("person_notes", person_notes(read, ours, staff, ctx))
    out.add("project_company_contacts", project_company_contacts(read, jobs, contacts))
    out.add("candidates", candidates(read, ours, jobs, staff, ctx))
