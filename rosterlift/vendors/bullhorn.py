"""Bullhorn: one user table for candidates, contacts and staff; duplicates link contact and candidate."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.codes import code_groups, code_map, country_name
from ..functions.dates import iso
from ..functions.predicates import not_blank
from ..functions.text import label_slug, strip_tags
from ..operators.chains import survivors
from ..operators.history import outcome, project_state
from ..operators.joins import fk_map, keep_any
from ..operators.reshape import explode_list, union_all
from ..plans.attributes import build_attribute_options, build_attribute_values, build_custom_attributes
from ..plans.candidates import build_candidates, build_placements
from ..plans.career import build_educations, build_experiences
from ..plans.companies import build_companies, build_company_contacts
from ..plans.fees import build_fee_splits, build_fee_types, build_project_fees
from ..plans.files import build_file_mapping
from ..plans.identities import build_company_identities, build_person_identities
from ..plans.notes import build_meetings, build_person_notes
from ..plans.people import build_people, build_users, duplicate_people, import_scope
from ..plans.projects import build_project_company_contacts, build_projects
from ..plans.salaries import build_salary_rates
from ..sources.sinks import Outputs
from ..sources.tables import SourceMap

_ADDED, _MODIFIED = "try_cast(dateadded AS timestamp)", "try_cast(datelastmodified AS timestamp)"

USERS = SourceMap("bh_usercontact", {
    "id": "userid", "first_name": "firstname", "last_name": "lastname", "email": "email", "added_at": _ADDED,
    "modified_at": _MODIFIED})
PEOPLE = SourceMap("bh_usercontact", {
    "id": "userid", "first_name": "firstname", "last_name": "lastname", "added_at": _ADDED, "modified_at": _MODIFIED,
    "address1": "address1", "address2": "address2", "city": "city", "state": "state", "zip": "zip",
    "country_id": "countryid"}, "lower(firstname) != 'default contact' AND isdeleted != 1")
LINKED = SourceMap("bh_usercontact", {"id": "userid", "linked_id": "linkeduserid"})
IDENTITIES = SourceMap("bh_usercontact", {
    "person_id": "userid", "email": "email", "email2": "email2", "phone": "phone", "phone2": "phone2",
    "mobile": "mobile", "workphone": "workphone", "linkedin": "customtext2", "linkedin2": "customtext3",
    "email_status": "customint1", "has_company": "clientcorporationid IS NOT NULL"})
COMPANIES = SourceMap("bh_clientcorporation", {
    "id": "clientcorporationid", "name": "name", "description": "companydescription", "status": "status",
    "restriction": "customtext1", "address1": "address1", "address2": "address2", "city": "city", "state": "state",
    "zip": "zip", "country_id": "countryid", "headcount": "numemployees", "added_at": _ADDED,
    "modified_at": _MODIFIED})
COMPANY_IDENTITIES = SourceMap("bh_clientcorporation", {
    "company_id": "clientcorporationid", "phone": "phone", "website": "companyurl",
    "linkedin": "linkedinprofilename"})
COMPANY_NOTES = SourceMap("bh_clientcorporation", {
    "company_id": "clientcorporationid", "notes": "notes", "added_at": _ADDED, "modified_at": _MODIFIED})
CONTACTS = SourceMap("bh_client", {
    "id": "clientid", "person_id": "userid", "company_id": "clientcorporationid", "status": "status",
    "added_at": _ADDED}, "isdeleted != 1")
COMMENTS = SourceMap("bh_usercomment", {
    "id": "usercommentid", "person_id": "userid", "created_by_id": "commentinguserid", "comments": "comments",
    "action": "action", "added_at": _ADDED})
EXPERIENCES = SourceMap("bh_userworkhistory", {
    "id": "userworkhistoryid", "person_id": "userid", "company_name": "companyname", "title": "title",
    "started_at": "startdate", "finished_at": "enddate", "description": "comments"})
EDUCATIONS = SourceMap("bh_usereducation", {
    "id": "usereducationid", "person_id": "userid", "school": "school", "degree": "degree",
    "field_of_study": "major", "grade": "gpa", "started_at": "startdate", "finished_at": "enddate"})
PROJECTS = SourceMap("bh_jobopportunity", {
    "id": "jobpostingid", "linked_id": "linkedjobpostingid", "title": "title", "employment_type": "employmenttype",
    "salary": "salary", "public_description": "publicdescription", "description": "description",
    "owner_id": "userid", "company_id": "clientcorporationid", "status": "status", "added_at": _ADDED,
    "closed_at": "try_cast(dateclosed AS timestamp)", "address1": "address", "address2": "address2", "city": "city",
    "state": "state", "zip": "zip"}, "isdeleted = 0")
PROJECT_CONTACTS = SourceMap("bh_jobopportunity", {"project_id": "jobpostingid", "person_id": "clientuserid"})
CANDIDATES = SourceMap("bh_jobresponse", {
    "id": "jobresponseid", "project_id": "jobpostingid", "person_id": "userid", "owner_id": "sendinguserid",
    "status": "status", "added_at": _ADDED})
HISTORY = SourceMap("bh_jobresponsehistory", {"id": "jobresponseid", "status": "status", "added_at": _ADDED})
PLACEMENTS = SourceMap("bh_placement", {
    "id": "placementid", "person_id": "userid", "project_id": "jobpostingid", "salary": "salary", "rate": "fee",
    "comments": "comments", "added_at": _ADDED})
SALARIES = SourceMap("bh_usercontact", {
    "person_id": "userid", "salary": "salary", "day_rate": "dayrate", "hourly_rate": "hourlyrate", "added_at": _ADDED})

# What the vendor's statuses mean.
COMPANY_STATUS = {"client": ["active", "terms signed"], "none": ["archive", "passive", "prospect"]}
RESTRICTIONS = {"NO": "hard", "DO NOT SOURCE": "hard", "SOURCE WITH CARE": "soft"}
CONTACT_STATUS = {"Client": "client", "Active": "client", "Prospect": "prospect", "New Lead": "prospect",
                  "Passive": "prospect", "Imported": "prospect"}
CONTRACT_TYPES = {"Contract": "contract", "Temporary": "contract", "Fixed Term": "contract", "RAAS": "contract"}
PROJECT_STATES = {
    "lead": ["qualifying"],
    "active": ["1 qualified", "2 resourcing", "3 interviews", "4 final interview", "5 offer out", "converted",
               "offer out", "negotiating"],
    "on_hold": ["7 - on hold", "7 on hold", "on hold", "accepting candidates", "covered", "open"],
}
CLOSE_REASONS = {"cancelled": ["10 cancelled", "7 on hold / cancelled", "archive", "closed", "cancelled"],
                 "won": ["6 placed", "placed", "closed-won"], "lead_lost": ["spec cv sent"]}
CANDIDATE_STATUS = {
    "Hired": ["6 placed", "placed"],
    "Client IV": ["1st interview", "2nd interview", "3rd interview", "final interview", "1st phone screen",
                  "2nd phone screen", "1st onsite interview", "2nd onsite interview", "technical test",
                  "reference check", "interview", "further interview", "interview rejected", "interview/rejected",
                  "1st stage", "first stage", "mid stage", "second interview", "technical interview"],
    "Offer": ["offer extended", "offer rejected"],
    "Presented": ["submitted to client", "cv sent", "submitted", "new submission", "submission",
                  "client submission"],
    "Internal IV": ["screened", "shortlisted", "internally submitted", "interview scheduled"],
    "Added": ["rejected", "new lead", "shortlist", "longlist", "long list", "candidate rejected",
              "rejected not submitted", "of interest", "longlist - screened", "consultant rejected",
              "client rejected", "rejected by client", "online response", "candidate interested",
              "candidate not interested", "sales rep rejected"],
}
REJECTION_TYPES = {
    "by_us": ["rejected", "rejected not submitted", "consultant rejected", "sales rep rejected"],
    "self": ["candidate rejected", "offer rejected", "candidate not interested"],
    "by_client": ["interview rejected", "interview/rejected", "rejected by client", "client rejected"],
}
REJECTION_REASONS = {"candidate rejected": "not_qualified", "offer rejected": "accepted_another_offer",
                     "client rejected": "not_qualified"}


def _by_code(groups: dict[str, list[str]]) -> dict[str, str]:
    return {code: result for result, codes in groups.items() for code in codes}


def company_scope(read: Callable[[str], DataFrame]) -> DataFrame:
    """Companies with a contact somebody commented on, or with a project."""
    clients, comments = read("bh_client"), read("bh_usercomment")
    noted = keep_any(clients, "userid", (comments, "userid"))
    ids = read("bh_clientcorporation").select(F.col("clientcorporationid").alias("id"))
    return import_scope(ids, "id", [(noted, "clientcorporationid"), (read("bh_jobopportunity"), "clientcorporationid")],
                        "company_id")


@dataclass(frozen=True)
class AttributeSource:
    """A custom attribute of one export: its name, the kind of record, and the column that holds its values.

    With ``separator`` the column holds lists, of any length. ``value`` is an SQL expression.
    """

    name: str
    of: str
    table: str
    owner: str
    value: str
    separator: str | None = None


def attribute_values(read: Callable[[str], DataFrame], sources: Sequence[AttributeSource]) -> DataFrame:
    """owner_id, alias, of, value: what the records hold, lists taken apart; blanks and zeros are no values."""
    parts = []
    for source in sources:
        held = read(source.table).selectExpr(f"{source.owner} AS owner_id", f"CAST({source.value} AS STRING) AS value")
        if source.separator is not None:
            held = explode_list(held, "value", "value", source.separator)
        parts.append(held.select("owner_id", label_slug(F.lit(source.name)).alias("alias"), F.lit(source.of).alias("of"),
                                 F.trim("value").alias("value")))
    return union_all(*parts).where("value IS NOT NULL AND value NOT IN ('', '0')")


def add_attributes(read: Callable[[str], DataFrame], ctx: RunContext, out: Outputs, sources: Sequence[AttributeSource],
                   owners: dict[str, DataFrame]) -> None:
    """Attributes, their options, and the values of each kind of record."""
    held = attribute_values(read, sources)
    named = [(s.name, s.of, s.separator is not None) for s in sources]
    attributes = out.add("custom_attributes", build_custom_attributes(held.sparkSession, named, ctx))
    options = out.add("custom_attribute_options", build_attribute_options(held.select("alias", "value").distinct(), attributes, ctx))
    for entity in dict.fromkeys(s.of for s in sources):
        values = held.where(F.col("of") == entity).select("owner_id", "alias", "value")
        out.add(f"{entity}_custom_attribute_values", build_attribute_values(values, options, attributes, owners[entity], ctx, entity))


def tables(read: Callable[[str], DataFrame], ctx: RunContext, out: Outputs, prior_users: DataFrame | None = None,
           scoped: bool = True, attributes: Sequence[AttributeSource] = (), salaries: bool = False) -> None:
    """``scoped`` keeps only people and companies with some activity. ``attributes``: the custom attributes of the export.
    ``salaries``: whether its people have salary, day rate and hourly rate columns."""
    comments = COMMENTS.read(read)
    user_ids = read("bh_usercontact").select(F.col("userid").alias("id"))
    seen = [(read("bh_usercomment"), "userid"), (read("bh_client"), "userid")]
    people_scope = out.add("people_to_import", import_scope(user_ids, "id", seen, "person_id"))
    companies_scope = out.add("companies_to_import", company_scope(read))
    dupes = out.add("people_dupes", survivors(duplicate_people(LINKED.read(read), read("bh_client"), "userid")).drop("in_cycle"))

    users = out.add("users", build_users(USERS.read(read), ctx, prior_users))
    people = out.add("people", build_people(
        PEOPLE.read(read).withColumn("country", country_name("country_id")), ctx, people_scope if scoped else None,
        dupes, users))
    companies = out.add("companies", build_companies(
        COMPANIES.read(read).withColumn("country", country_name("country_id")), ctx,
        code_groups("status", COMPANY_STATUS, "none"), code_map("restriction", RESTRICTIONS, "none"),
        scope=companies_scope if scoped else None))
    titles = read("bh_usercontact").select("userid", F.col("occupation"))
    titled = fk_map(CONTACTS.read(read), "person_id", titles, "occupation", "title", "userid", policy="exclude")
    contacts = out.add("company_contacts", build_company_contacts(
        titled, companies, people, ctx, code_map("status", CONTACT_STATUS, "none"), dupes))
    projects = out.add("projects", build_projects(
        PROJECTS.read(read), companies, users, ctx, code_map("employment_type", CONTRACT_TYPES, "full_time"),
        project_state(F.col("status"), PROJECT_STATES, CLOSE_REASONS, iso("closed_at"), iso("added_at"))))
    marks = outcome(F.lower(F.trim("status")), _by_code(CANDIDATE_STATUS), _by_code(REJECTION_TYPES), REJECTION_REASONS,
                    iso("added_at"), default_status=None)
    candidates = out.add("candidates", build_candidates(
        CANDIDATES.read(read), projects, people, users, ctx, marks, HISTORY.read(read)))
    fee_types = out.add("fee_types", build_fee_types(comments.sparkSession, ctx))
    fees = out.add("project_fees", build_project_fees(PLACEMENTS.read(read), people, projects, fee_types, ctx))
    out.add("placements", build_placements(fees, candidates))
    out.add("project_fee_splits", build_fee_splits(commissions(read), projects, users, fee_types, ctx))
    out.add("person_identities", build_person_identities(IDENTITIES.read(read), people, ctx, dupes))
    out.add("company_identities", build_company_identities(COMPANY_IDENTITIES.read(read), companies, ctx))
    out.add("person_notes", build_person_notes(comments, people, users, ctx, dupes))
    out.add("company_notes", company_notes(COMPANY_NOTES.read(read), companies, ctx))
    out.add("meetings", build_meetings(comments, people, users, ctx, dupes))
    out.add("experiences", build_experiences(EXPERIENCES.read(read), people, companies, ctx, dupes))
    out.add("educations", build_educations(EDUCATIONS.read(read), people, ctx, dupes))
    out.add("project_company_contacts", build_project_company_contacts(PROJECT_CONTACTS.read(read), contacts, projects))
    out.add("file_person_mapping", build_file_mapping(files(read), people))
    if salaries:
        out.add("person_salaries", build_salary_rates(SALARIES.read(read), people, ctx))
    if attributes:
        add_attributes(read, ctx, out, attributes, {"person": people, "company": companies, "project": projects})


def company_notes(raw: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    """The one free note a company carries."""
    rows = fk_map(raw.where(not_blank("notes")), "company_id", companies, "atlas_id", "atlas_company_id",
                  policy="exclude")
    return rows.select(
        F.col("company_id").alias("id"), ctx.record_id(F.lit("companynote"), "company_id").alias("atlas_id"),
        "company_id", "atlas_company_id", strip_tags("notes", " ").alias("text"), F.lit("manual").alias("type"),
        iso("added_at").alias("created_at"), iso("modified_at").alias("updated_at"),
        F.lit(None).cast("string").alias("created_by_id"), ctx.master().alias("created_by_atlas_id"))


def commissions(read: Callable[[str], DataFrame]) -> DataFrame:
    """Commissions with the project of their placement and the address of their earner."""
    split = read("bh_commission").select(F.col("commissionid").alias("id"), "placementid", "userid",
                                         F.col("commissionpercentage").alias("rate"))
    rows = fk_map(split, "placementid", read("bh_placement"), "jobpostingid", "project_id", "placementid", policy="exclude")
    return fk_map(rows, "userid", read("bh_usercontact"), "email", "email", "userid", policy="exclude")


def files(read: Callable[[str], DataFrame]) -> DataFrame:
    work = read("bh_userwork").select(F.col("userworkid").alias("_work"), F.struct("userid", "name", "type").alias("_w"))
    stored = read("bh_userworkfile").selectExpr("userworkfileid AS id", "userworkid", "directory AS folder",
                                                "fileextension AS extension", f"{_ADDED} AS added_at")
    rows = fk_map(stored, "userworkid", work, "_w", "_w", "_work", policy="exclude")
    return rows.select("id", F.col("_w.userid").alias("owner_id"), "folder", F.col("_w.name").alias("name"),
                       F.col("_w.type").alias("label"), "extension", "added_at")
