"""Invenias: records of one id column, every link between two records in a relation table of its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.codes import code_map
from ..functions.contact import in_domain, linkedin_norm
from ..functions.dates import iso
from ..functions.ids import uuid_from
from ..functions.location import prefer_filled
from ..functions.names import title_and_company
from ..functions.predicates import not_blank
from ..functions.text import clean_html, strip_prefix
from ..operators.dedupe import keep_first
from ..operators.history import effective_status, override_by_link
from ..operators.joins import fk_map, one_per_key
from ..operators.numbering import number_within
from ..operators.reshape import settings_to_columns, union_all, unpivot
from ..plans.identities import CLASS_TYPES
from ..plans.projects import build_project_users
from ..sources.sinks import Outputs

Read = Callable[[str], DataFrame]

# What the vendor's list entries mean.
CLIENT_STATUS = {"current": "client", "prospect": "target", "cold": "target"}
PROJECT_STATE = {"Placement": "closed", "Completed": "closed", "Cancelled": "closed", "Lost": "closed", "On Hold": "on_hold",
                 "Active": "active", "Offer": "active", "Speculative": "lead", "Pending": "lead"}
CLOSE_REASON = {"Placement": "won", "Completed": "won", "Cancelled": "worked_lost", "Lost": "worked_lost"}
STATUS = {
    "12. Placed": "Hired", "11. Offer": "Offer", "10. Finalist(s)": "Client IV", "09. Client Interview": "Client IV",
    "09. 3+ Client Interview": "Client IV", "09. 2nd Client Interview": "Client IV", "09. 1st Client Interview": "Client IV",
    "08. Submitted to Client": "Presented", "07. Shortlisted": "Presented", "06. Consultant Interview": "Internal IV",
    "Candidate Held": "Internal IV",
}
REJECTION = {
    "Rejected by Client": "by_client", "09. Rejected after 1st Client interview": "by_client",
    "09. Rejected after 2nd Client interview": "by_client", "09. Rejected after 3+ Client interview": "by_client",
    "Rejected by Candidate": "self", "09. Rejected by Candidate after Client Interview": "self",
    "Rejected by Candidate - Location": "self", "Rejected by Candidate - Role": "self",
    "Rejected by Candidate - Timing": "self", "Rejected by Consultant": "by_us", "Rejected": "by_us",
}
REJECTED_FOR_LOCATION = "Rejected by Candidate - Location"
LOCATION_LABELS = ["CityFieldLabel", "PostcodeFieldLabel", "CountyFieldLabel"]
BASIC_SALARY = "Basic Salary"


def _ts(name: str) -> Column:
    return F.col(name).try_cast("timestamp")


def _stamps(style: str = "seconds") -> list[Column]:
    return [iso(_ts("datecreated"), style).alias("created_at"), iso(_ts("datemodified"), style).alias("updated_at")]


def _id(ctx: RunContext, *parts: Column | str) -> Column:
    return uuid_from(ctx.client, *parts).alias("atlas_id")


def _one_link(read: Read, table: str, key: str, value: str) -> DataFrame:
    """A relation table as key -> the smallest linked id."""
    return one_per_key(read(table).where(F.col(key).isNotNull()), [F.col(key).alias("k")], F.min(value).alias("v"))


def _authors(rows: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    for key, name in (("creatorid", "created_by"), ("modifierid", "updated_by")):
        rows = fk_map(rows, key, users, "id", f"{name}_id")
        rows = fk_map(rows, key, users, "atlas_id", f"{name}_atlas_id", default=ctx.master())
    return rows


_AUTHORS = ("created_by_id", "created_by_atlas_id", "updated_by_id", "updated_by_atlas_id")


def users(read: Read, ctx: RunContext, prior: DataFrame) -> DataFrame:
    """``prior``: id, email, name, status of the users the target knows."""
    person = read("people").select("itemid", F.col("fileas"))
    rows = read("users").where(in_domain("username", ctx.domain.lower()))
    rows = fk_map(rows, "itemid", _one_link(read, "relation_usertoperson", "userid", "personid"), "v", "_person", "k", policy="exclude")
    rows = fk_map(rows, "_person", person, "fileas", "_name", "itemid", policy="exclude")
    known = one_per_key(prior.where(not_blank("email")), [F.lower("email").alias("k")], F.min(F.struct("id", "email", "name", "status")).alias("p"))
    rows = fk_map(rows, F.lower(F.trim("username")), known, "p", "_p", "k")
    return rows.select(
        F.col("itemid").alias("id"), F.coalesce("_p.id", uuid_from(ctx.client, "itemid")).alias("atlas_id"), F.coalesce("_p.email", "username").alias("email"),
        F.coalesce("_p.name", "_name").alias("name"), F.coalesce("_p.status", F.when(F.col("disabled"), "disabled").otherwise("active")).alias("status"))


def people(read: Read, users: DataFrame, ctx: RunContext, place_list: str | None) -> DataFrame:
    """People, without mailboxes filed as one; the category of the list of places stands in for a missing country."""
    place = read("categorylistentries").where((F.col("categorylistid").eqNullSafe(F.lit(place_list))) & F.col("parentlistentryid").isNotNull() & (F.col("fileas") != "Europe"))
    linked = fk_map(read("relation_persontocategorylistentry"), "categorylistentryid", place, "fileas", "_place", "itemid", policy="exclude")
    known = one_per_key(linked, [F.col("person").alias("k")], F.min("_place").alias("v"))
    first, last, mail = (F.coalesce(c, F.lit("")) for c in ("firstname", "familyname", "email1address"))
    rows = read("people").where(~(first.contains("@") | last.contains("@") | (first == mail) | (last == mail)))
    rows = _authors(fk_map(rows, "itemid", known, "v", "_place", "k"), users, ctx)
    country, region, city = prefer_filled(F.coalesce("homecountry", "_place")), prefer_filled("homestate"), prefer_filled("homecity")
    none = F.lit("")
    return rows.select(
        F.col("itemid").alias("id"), _id(ctx, "itemid"), F.col("firstname").alias("first_name"), F.col("familyname").alias("last_name"),
        F.nullif(F.concat_ws(" ", prefer_filled("homepostalcode"), prefer_filled("homestreet")), none).alias("location_street_address"),
        F.nullif(F.concat_ws(", ", country, region, city), none).alias("location_locality"), city.alias("location_metro"),
        region.alias("location_region"), country.alias("location_country"), *_AUTHORS, *_stamps(), ctx.agency().alias("agency_id"),
        F.lit("active").alias("responsiveness"), F.lit("regular").alias("candidate_status"))


def person_identities(read: Read, people: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    scope = F.when(F.col("typeclientchecked"), "corporate").otherwise("personal")
    link = F.col("linkedin")
    for prefix in ("https://", "http://", "www."):
        link = F.replace(link, F.lit(prefix), F.lit(""))
    link = F.btrim(link, F.lit("/"))
    yes = F.lit(True)
    rows = unpivot(read("people").withColumn("person_id", F.col("itemid")), ["person_id", "creatorid", "modifierid", "datecreated", "datemodified"], [
        {"type": F.lit("email"), "value": F.when(not_blank("email1address"), F.col("email1address")), "identity_type_type": scope, "favourite": yes,
         "key": F.col("email1address")},
        {"type": F.lit("phone"), "value": F.when((F.col("mobilephone") != "") & ~F.col("mobilephone").contains("@"), F.col("mobilephone")),
         "identity_type_type": scope, "favourite": yes, "key": F.col("mobilephone")},
        {"type": F.lit("linkedin"), "value": F.when(link.contains("linkedin.com/in/"), linkedin_norm(link)), "identity_type_type": F.lit("personal"),
         "favourite": F.lit(False), "key": link}])
    rows = rows.withColumn("_value", F.lower(F.trim("value")))
    rows = keep_first(rows, ["_value", "type"], [_ts("datecreated").asc_nulls_last(), F.col("person_id").asc()])
    rows = _authors(fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude"), users, ctx)
    return rows.select(
        _id(ctx, "key"), "value", "favourite", yes.alias("active"), "type", "identity_type_type", code_map("type", CLASS_TYPES).alias("class_type"),
        "person_id", F.lit("migration").alias("source"), "created_by_id", "created_by_atlas_id", F.lit(False).alias("hidden"), yes.alias("verified"),
        *_stamps(), "atlas_person_id")


def companies(read: Read, users: DataFrame, ctx: RunContext) -> DataFrame:
    """Companies with their newest location; field labels stand in for missing parts of it."""
    labels = settings_to_columns(read("companylocationsettings"), "companylocationid", "settingname", "settingvalue", LOCATION_LABELS)
    packed = one_per_key(labels, [F.col("companylocationid").alias("k")], F.min(F.struct(*LOCATION_LABELS)).alias("l"))
    known = read("locations").select(
        "itemid", F.struct(F.coalesce(_ts("datemodified"), _ts("datecreated")).alias("at"), "businessstreet", "businesspostalcode", "businesscity",
                           "businessstate", "businesscountry").alias("p"))
    held = fk_map(read("relation_companytolocation"), "locationid", known, "p", "_p", "itemid", policy="exclude")
    held = fk_map(held, "locationid", packed, "l", "_l", "k")
    newest = keep_first(held, ["companyid"], [F.coalesce(_ts("datemodified"), _ts("datecreated")).desc_nulls_last(),
                                              F.col("_p.at").desc_nulls_last(), F.col("locationid").asc()])
    place = newest.select(F.col("companyid").alias("k"), F.struct(F.col("_p"), F.col("_l")).alias("v"))
    rows = _authors(fk_map(read("companies"), "itemid", place, "v", "_v", "k"), users, ctx)
    rows = fk_map(rows, "clientstatus", read("lookuplistentries"), "name", "_status", "itemid")
    p = {n: F.col(f"_v._p.business{n}") for n in ("street", "postalcode", "city", "state", "country")}
    label = {n: F.col(f"_v._l.{n}") for n in LOCATION_LABELS}
    none = F.lit("")
    line = F.concat_ws(", ", *[F.nullif(p[n], none) for n in ("country", "state", "city", "postalcode", "street")])
    barred = F.coalesce(F.col("offmarketstatus") == 1, F.lit(False))
    return rows.select(
        F.col("itemid").alias("id"), _id(ctx, "itemid"), F.col("fileas").alias("name"),
        F.coalesce(F.concat(p["postalcode"], F.lit(" "), p["street"]), none).alias("location_street_address"), line.alias("location_locality"),
        F.coalesce(p["city"], label["CityFieldLabel"], none).alias("location_metro"), F.coalesce(p["state"], label["CountyFieldLabel"], none).alias("location_region"),
        F.coalesce(p["country"], none).alias("location_country"), F.coalesce(p["postalcode"], label["PostcodeFieldLabel"], none).alias("location_postal_code"),
        *_AUTHORS, *_stamps(), ctx.agency().alias("agency_id"), code_map(F.lower("_status"), CLIENT_STATUS, "none").alias("relationship"),
        F.when(barred, "hard").alias("restriction_type"), F.when(barred, iso(_ts("offmarketstartdate"), "midnight")).alias("restriction_created_at"),
        F.when(barred, F.coalesce("offmarketownerid", ctx.master())).alias("restriction_created_by_id"),
        F.when(barred, F.col("offmarketreason")).alias("restriction_note"))


def company_identities(read: Read, companies: DataFrame, ctx: RunContext) -> DataFrame:
    def bare(column: str) -> Column:
        value = F.col(column)
        for prefix in ("https://", "http://", "www."):
            value = F.replace(value, F.lit(prefix), F.lit(""))
        return F.btrim(value, F.lit("/"))

    rows = unpivot(read("companies").withColumn("company_id", F.col("itemid")), ["company_id", "datecreated"], [
        {"type": F.lit("website"), "key": F.col("webpage"), "value": F.when(not_blank("webpage") & ~F.lower("webpage").contains("linkedin.com"), bare("webpage"))},
        {"type": F.lit("linkedin"), "key": F.col("linkedin"), "value": F.when(F.col("linkedin").contains("linkedin.com"), bare("linkedin"))}])
    rows = keep_first(rows, ["value", "type"], [_ts("datecreated").asc_nulls_last(), F.col("company_id").asc()])
    rows = fk_map(rows, "company_id", companies, "atlas_id", "atlas_company_id")
    return rows.select("company_id", "value", _id(ctx, "key"), iso(_ts("datecreated")).alias("created_at"), "type", ctx.agency().alias("agency_id"),
                       (F.col("type") == "website").alias("is_primary"), "atlas_company_id")


def company_notes(read: Read, companies: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(read("companies").where(not_blank("internalcomments")), "itemid", companies, "atlas_id", "atlas_company_id", policy="exclude")
    return _authors(rows, users, ctx).select(
        F.col("itemid").alias("id"), _id(ctx, "atlas_company_id", "internalcomments"), clean_html("internalcomments").alias("text"), *_stamps(), *_AUTHORS,
        F.lit("manual").alias("type"), F.col("itemid").alias("company_id"), "atlas_company_id")


def _positions(read: Read) -> DataFrame:
    """Positions with their person and company."""
    rows = fk_map(read("positions"), "itemid", _one_link(read, "relation_persontoposition", "positionid", "personid"), "v", "person_id", "k", policy="exclude")
    return fk_map(rows, "itemid", _one_link(read, "relation_companytoposition", "positionid", "companyid"), "v", "company_id", "k")


def company_contacts(read: Read, people: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    """The newest open position of each person at each company."""
    held = _positions(read).where((F.col("positionstatus") == 0) & F.col("enddate").isNull() & F.col("company_id").isNotNull())
    held = keep_first(held, ["person_id", "company_id"], [F.coalesce(_ts("datemodified"), _ts("datecreated")).desc_nulls_last(), F.col("itemid").desc()])
    person = people.select("id", F.struct("atlas_id", "created_at", "updated_at").alias("p"))
    firm = companies.select("id", F.struct("atlas_id", "relationship").alias("c"))
    rows = fk_map(fk_map(held, "person_id", person, "p", "_p", policy="exclude"), "company_id", firm, "c", "_c", policy="exclude")
    return rows.select(
        "person_id", F.col("_p.atlas_id").alias("atlas_person_id"), _id(ctx, "person_id", "company_id"), F.concat_ws("_", "person_id", "company_id").alias("id"),
        "company_id", F.col("_c.atlas_id").alias("atlas_company_id"), F.col("_p.created_at").alias("created_at"), F.col("_p.updated_at").alias("updated_at"),
        F.when(F.col("_c.relationship") == "client", "client").otherwise("prospect").alias("relationship"),
        F.coalesce("jobtitle", F.lit("contact")).alias("title"))


def experiences(read: Read, people: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(_positions(read), "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    firm = companies.select("id", F.struct("atlas_id", "name").alias("c"))
    rows = fk_map(rows, "company_id", firm, "c", "_c")
    title, _ = title_and_company("jobtitle", F.lit(None))
    told = F.when(F.col("jobtitle").contains("@"), F.nullif(F.trim(F.split_part("jobtitle", F.lit("@"), F.lit(2))), F.lit("")))
    out = rows.select(
        F.col("itemid").alias("id"), _id(ctx, "itemid"), F.col("startdate").try_cast("date").cast("string").alias("started_at"),
        F.col("enddate").try_cast("date").cast("string").alias("finished_at"), "person_id", "atlas_person_id", title.alias("title"),
        F.coalesce(told, "_c.name").alias("company_name"), "description", "company_id", F.col("_c.atlas_id").alias("atlas_company_id"),
        ctx.agency().alias("agency_id"), F.lit("migration").alias("source"))
    return out.where(F.col("started_at").isNotNull() & F.col("title").isNotNull() & not_blank("company_name"))


def educations(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(read("personeducation"), "itemid", _one_link(read, "relation_persontoeducation", "personeducationid", "personid"), "v", "person_id", "k", policy="exclude")
    rows = fk_map(rows.where(not_blank("placeofstudy")), "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    started = F.col("startdate").try_cast("date")
    return rows.where(started.isNotNull()).select(
        F.col("itemid").alias("id"), _id(ctx, "itemid"), started.cast("string").alias("started_at"),
        F.col("enddate").try_cast("date").cast("string").alias("finished_at"), F.col("subject").alias("field_of_study"),
        F.col("placeofstudy").alias("name"), F.lit("migration").alias("source"), "person_id", "atlas_person_id")


def person_notes(read: Read, people: DataFrame, users: DataFrame, ctx: RunContext, call_note: str | None) -> DataFrame:
    """Calls, mails and notes, once per linked person. Notes of type ``call_note`` are calls."""
    def side(table: str, body: str, at: str, relation: str, key: str, kind: Column) -> DataFrame:
        texts = read(table).select("itemid", clean_html(body).alias("text"), iso(_ts(at)).alias("created_at"), iso(_ts("datemodified")).alias("updated_at"),
                                   F.col("creatorid").alias("created_by_id"), kind.alias("type"))
        links = read(relation).select(F.col(key).alias("itemid"), F.col("personid").alias("person_id")).distinct()
        links = fk_map(links, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
        return links.join(texts, "itemid")

    call = F.when(F.col("noteactiontype") == F.lit(call_note), "phone_call").otherwise("manual")
    rows = union_all(
        side("telephones", "content", "telephoneactiondate", "relation_persontotelephone", "telephoneid", F.lit("phone_call")),
        side("emails", "body", "datecreated", "relation_persontoemail", "emailid", F.lit("manual")),
        side("notes", "content", "datecreated", "relation_persontonote", "noteid", call)).where(not_blank("text") & (F.col("text") != "..."))
    rows = fk_map(rows, "created_by_id", users, "atlas_id", "created_by_atlas_id", default=ctx.master())
    return rows.select(F.col("itemid").alias("id"), _id(ctx, "itemid", "person_id"), "text", "created_at", "updated_at", "created_by_id", "created_by_atlas_id",
                       "type", "person_id", "atlas_person_id")


def projects(read: Read, companies: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    tracked = one_per_key(read("relation_assignmenttoprogresstracking"), [F.col("assignmentid").alias("k")], F.max(F.to_date(_ts("datecreated"))).alias("v"))
    rows = fk_map(read("assignments"), "itemid", _one_link(read, "relation_companytoassignment", "assignmentid", "companyid"), "v", "company_id", "k", policy="exclude")
    rows = fk_map(rows, "company_id", companies, "atlas_id", "atlas_company_id", policy="exclude")
    rows = fk_map(rows, "status", read("lookuplistentries"), "name", "_status", "itemid")
    rows = fk_map(rows, "itemid", tracked, "v", "_tracked", "k")
    rows = fk_map(rows, "ownerid", users, "atlas_id", "atlas_owner_id", default=ctx.master())
    reason = code_map("_status", CLOSE_REASON)
    return rows.select(
        F.col("itemid").alias("id"), _id(ctx, "itemid"), F.col("fileas").alias("job_role"), *_stamps(), F.lit("contract").alias("contract_type"),
        F.lit("project").alias("class_type"), F.lit("1").alias("hire_target"), F.col("ownerid").alias("owner_id"), "atlas_owner_id",
        F.lit(False).alias("public"), code_map("_status", PROJECT_STATE, "on_hold").alias("state"),
        F.when(reason.isNotNull(), iso("_tracked")).alias("closed_at"), reason.alias("close_reason"), ctx.agency().alias("agency_id"), "company_id",
        "atlas_company_id", F.col("assignmentnumber").alias("job_number"))


def project_company_contacts(read: Read, projects: DataFrame, contacts: DataFrame) -> DataFrame:
    """Assignment clients of a project with the person's first contact row."""
    held = one_per_key(contacts, [F.col("person_id").alias("k")], F.min("atlas_id").alias("v"))
    rows = fk_map(read("relation_assignmenttoassignmentclient"), "assignmentclientid",
                  _one_link(read, "relation_persontoassignmentclient", "assignmentclientid", "personid"), "v", "company_contact_id", "k", policy="exclude")
    rows = fk_map(rows, "company_contact_id", held, "v", "atlas_company_contact_id", "k", policy="exclude")
    rows = fk_map(rows, "assignmentid", projects, "atlas_id", "atlas_project_id", policy="exclude")
    return rows.select(F.col("assignmentid").alias("project_id"), "company_contact_id", "atlas_project_id", "atlas_company_contact_id").distinct()


def candidates(read: Read, projects: DataFrame, people: DataFrame, ctx: RunContext) -> DataFrame:
    """The standing status of each candidacy; a placement makes it hired."""
    keys = ["person_id", "project_id"]
    rows = fk_map(read("relation_candidatetoassignment"), "recordstatus", read("lookuplistentries"), "name", "_name", "itemid")
    rows = rows.select("relationid", F.col("personid").alias("person_id"), F.col("assignmentid").alias("project_id"),
                       F.coalesce(_ts("datemodified"), _ts("datecreated")).alias("ts"), F.trim(strip_prefix("_name", "*")).alias("status"))
    told = effective_status(rows, keys, "status", "ts", "relationid", tuple(REJECTION))
    newest = keep_first(rows, keys, [F.col("ts").desc_nulls_last(), F.col("relationid").desc()]).select(*keys, "relationid")
    rows = newest.join(told, keys).withColumn("status", code_map("effective_status", STATUS, "Added"))
    placed = fk_map(read("placements"), "itemid", _one_link(read, "relation_assignmenttoplacement", "placementid", "assignmentid"), "v", "project_id", "k")
    placed = fk_map(placed, "itemid", _one_link(read, "relation_persontoplacement", "placementid", "personid"), "v", "person_id", "k")
    rows = override_by_link(rows, keys, placed, "status", "Hired")
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    known = projects.select("id", F.struct("atlas_id", "owner_id", "atlas_owner_id").alias("p"))
    rows = fk_map(rows, "project_id", known, "p", "_p", policy="exclude")
    kind = code_map("latest_status", REJECTION)
    owner = F.coalesce("_p.atlas_owner_id", ctx.master())
    return rows.select(
        F.col("relationid").alias("id"), _id(ctx, "relationid"), "person_id", "atlas_person_id", "project_id", F.col("_p.atlas_id").alias("atlas_project_id"),
        F.lit("candidate").alias("class_type"), "status", kind.alias("rejection_type"),
        F.when(F.col("latest_status") == REJECTED_FOR_LOCATION, "location").when(kind.isNotNull(), "other").alias("rejection_reason"),
        F.when(kind.isNotNull(), iso("latest_at", "midnight")).alias("rejected_at"), F.when(kind.isNotNull(), owner).alias("atlas_rejected_by_id"),
        F.col("_p.owner_id").alias("owner_id"), owner.alias("atlas_owner_id"))


def person_salaries(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    """Permanent packages of the basic-salary kind, through the position they belong to."""
    basic = read("permanentpackagessettings").where(F.col("name") == BASIC_SALARY)
    rows = read("permanentpackages").where("amountfrom IS NOT NULL OR amountto IS NOT NULL")
    rows = fk_map(rows, "settingid", basic, "name", "_kind", "itemid", policy="exclude")
    rows = fk_map(rows, "itemid", _one_link(read, "relation_positiontopermanentpackage", "packageid", "positionid"), "v", "_position", "k", policy="exclude")
    rows = fk_map(rows, "_position", _one_link(read, "relation_persontoposition", "positionid", "personid"), "v", "person_id", "k", policy="exclude")
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    money = read("currencies").select("itemid", F.struct("currencycode", "currencyname").alias("c"))
    rows = fk_map(rows, "currency", money, "c", "_c", "itemid")
    return rows.select(
        F.col("itemid").alias("id"), uuid_from("", "itemid", "person_id").alias("atlas_id"), *_stamps("midnight"), ctx.agency().alias("agency_id"),
        F.col("creatorid").alias("created_by_id"), ctx.master().alias("created_by_atlas_id"), "person_id", "atlas_person_id",
        F.coalesce("amountfrom", "amountto").alias("basic_salary"), F.col("amountto").alias("total_salary"), F.col("amountfrom").alias("expected_salary_min"),
        F.col("amountto").alias("expected_salary_max"), F.col("_c.currencycode").alias("currency"),
        F.trim(F.split_part("_c.currencyname", F.lit(","), F.lit(1))).alias("country"), "notes", F.lit("gross").alias("tax_method"),
        F.lit("total").alias("expected_salary_type"), F.lit("migration").alias("source"), F.lit("actual").alias("type"),
        iso(_ts("datemodified"), "midnight").alias("relevant_date"))


def attributes(read: Read, people: DataFrame, ctx: RunContext, out: Outputs) -> None:
    """Category lists as attributes, their entries as options, the entries of a person as values."""
    day = {"created_at": F.lit(ctx.midnight_iso), "updated_at": F.lit(ctx.midnight_iso)}
    lists = out.add("custom_attributes", read("categorylists").select(
        F.col("itemid").alias("id"), _id(ctx, "itemid"), F.col("fileas").alias("name"), ctx.agency().alias("agency_id"), F.lit(True).alias("multiple_values"),
        F.lit("person").alias("of"), F.lit("options").alias("type"), F.lit(False).alias("ai")).withColumns(day))
    entries = fk_map(read("categorylistentries"), "categorylistid", lists, "atlas_id", "atlas_attribute_id", policy="exclude").select(
        F.col("itemid").alias("id"), _id(ctx, "itemid"), "atlas_attribute_id", F.col("fileas").alias("value"), ctx.agency().alias("agency_id"))
    numbered = number_within(entries, ["atlas_attribute_id"], ["value", "id"])
    options = out.add("custom_attribute_options", numbered.withColumns(day))
    choice = options.select("id", F.struct("atlas_attribute_id", "atlas_id").alias("o"))
    rows = fk_map(read("relation_persontocategorylistentry"), "categorylistentryid", choice, "o", "_o", policy="exclude")
    rows = fk_map(rows, "person", people, "atlas_id", "atlas_person_id", policy="exclude")
    out.add("person_custom_attribute_values", rows.select(
        _id(ctx, "relationid"), F.col("person").alias("person_id"), "atlas_person_id", F.col("_o.atlas_attribute_id").alias("atlas_custom_attribute_id"),
        F.col("_o.atlas_id").alias("atlas_option_id")).withColumns(day))


def tables(read: Read, ctx: RunContext, out: Outputs, prior_users: DataFrame, place_list: str | None = None,
           call_note: str | None = None) -> None:
    """``place_list`` and ``call_note``: the ids that the export gives the category list of places and the note type of calls."""
    staff = out.add("users", users(read, ctx, prior_users))
    ours, firms = out.add("people", people(read, staff, ctx, place_list)), out.add("companies", companies(read, staff, ctx))
    jobs = out.add("projects", projects(read, firms, staff, ctx))
    contacts = out.add("company_contacts", company_contacts(read, ours, firms, ctx))
    out.add("person_identities", person_identities(read, ours, staff, ctx))
    out.add("company_identities", company_identities(read, firms, ctx))
    out.add("company_notes", company_notes(read, firms, staff, ctx))
    out.add("person_notes", person_notes(read, ours, staff, ctx, call_note))
    out.add("experiences", experiences(read, ours, firms, ctx))
    out.add("educations", educations(read, ours, ctx))
    out.add("project_company_contacts", project_company_contacts(read, jobs, contacts))
    person = _one_link(read, "relation_persontoteammember", "teammemberid", "personid")
    team = fk_map(read("relation_assignmenttoteammember"), "teammemberid", person, "v", "_person", "k", policy="exclude")
    team = fk_map(team, "_person", _one_link(read, "relation_usertoperson", "personid", "userid"), "v", "user_id", "k", policy="exclude")
    owners = read("relation_assignmenttoowner").select(F.col("assignmentid").alias("project_id"), F.col("userid").alias("user_id"))
    out.add("project_users", build_project_users(team.withColumn("project_id", F.col("assignmentid")), owners, jobs, staff, ctx))
    out.add("candidates", candidates(read, jobs, ours, ctx))
    out.add("person_salaries", person_salaries(read, ours, ctx))
    attributes(read, ours, ctx, out)
