"""Bullhorn Bond Adapt: property tables per record kind, one entity table with the dates, link tables per stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.codes import code_map
from ..functions.contact import email_norm, linkedin_norm
from ..functions.dates import iso
from ..functions.ids import uuid_from
from ..functions.location import clean_placeholder, locality_cascade
from ..functions.predicates import not_blank
from ..functions.text import clean_html
from ..operators.dedupe import keep_first
from ..operators.joins import fk_map, one_per_key
from ..operators.reshape import union_all, unpivot
from ..plans.candidates import build_candidates_from_stages
from ..plans.identities import CLASS_TYPES
from ..plans.people import preferred_address
from ..sources.sinks import Outputs

Read = Callable[[str], DataFrame]


def _ts(value: str) -> Column:
    return F.col(value).try_cast("timestamp")


def _id(ctx: RunContext, *parts: Column | str) -> Column:
    return uuid_from(ctx.client, *parts).alias("atlas_id")


def _with_entity(rows: DataFrame, read: Read, key: str = "reference") -> DataFrame:
    """Rows with their entity's dates and authors as ``_h``; one entity per id."""
    held = read("entity_table").select(
        "entity_id", F.struct("created_by", "createddate", "updated_by", "updateddate", "deleteddate", "status").alias("h"))
    return fk_map(rows, key, held, "h", "_h", "entity_id")


def _dates(style: str) -> list[Column]:
    return [iso(_ts("_h.createddate"), style).alias("created_at"), iso(_ts("_h.updateddate"), style).alias("updated_at")]


def people(read: Read, ctx: RunContext) -> DataFrame:
    """People not deleted, with their best address cleaned of placeholders."""
    address = preferred_address(read("prop_address"), "reference", "street1", "bisuniqueid")
    parts = [clean_placeholder(c).alias(c) for c in ("street1", "town", "post_code", "county")]
    held = address.select("reference", F.struct(*parts, clean_placeholder("country", digits_ok=False).alias("country")).alias("a"))
    rows = fk_map(read("prop_person_gen"), "reference", held, "a", "_a", "reference")
    rows = _with_entity(rows, read).where("_h.deleteddate IS NULL")
    line = locality_cascade("_a.street1", "_a.town", "_a.post_code", "_a.county", "_a.country")
    return rows.select(
        F.col("reference").alias("id"), _id(ctx, "reference"), "first_name", "last_name", F.col("_h.created_by").alias("created_by_id"),
        ctx.master().alias("created_by_atlas_id"), F.col("_h.updated_by").alias("updated_by_id"),
        ctx.master().alias("updated_by_atlas_id"), *_dates("seconds"), ctx.agency().alias("agency_id"),
        F.lit("active").alias("responsiveness"), F.lit("regular").alias("candidate_status"),
        F.coalesce(line, F.col("_a.street1")).alias("location_locality"), F.col("_a.street1").alias("location_street_address"),
        F.col("_a.town").alias("location_name"), F.col("_a.county").alias("location_metro"),
        F.col("_a.country").alias("location_country"))


def person_identities(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    """Mails, numbers and profiles; the oldest record of a value keeps it."""
    def kind(table: str, type_: str, column: str, value: Column, row: str, seed: str, keep: Column) -> DataFrame:
        kept = list(dict.fromkeys(("person_id", "reference", row, column)))
        rows = unpivot(read(table).withColumn("person_id", F.col("reference")), kept, [{"value": F.when(keep, value)}])
        rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
        rows = _with_entity(rows, read)
        rows = keep_first(rows, ["value"], [_ts("_h.createddate").asc_nulls_last(), F.col(row).asc()])
        return rows.select(
            F.concat(F.col(row).cast("string"), F.lit(f"_{type_}")).alias("id"), _id(ctx, seed, column), "person_id", "atlas_person_id",
            *_dates("midnight"), F.lit(type_).alias("type"), "value")

    number = F.col("tel_number")
    plain = not_blank("tel_number") & ~number.rlike("(?i)@|^http|^mailto:") & (F.length(number) >= 6)
    rows = union_all(
        kind("prop_email", "email", "email_add", email_norm("email_add"), "bisuniqueid", "bisuniqueid", not_blank("email_add")),
        kind("prop_telephone", "phone", "tel_number", number, "bisuniqueid", "reference", plain),
        kind("prop_person_gen", "linkedin", "linkedin", linkedin_norm("linkedin"), "reference", "reference", not_blank("linkedin")))
    return rows.withColumns({
        "identity_type_type": F.lit("personal"), "class_type": code_map("type", CLASS_TYPES), "source": F.lit("migration"),
        "created_by_id": F.lit("1"), "created_by_atlas_id": ctx.master(), "updated_by_atlas_id": ctx.master(),
        "bounced": F.lit(False), "hidden": F.lit(False), "favourite": F.lit(False), "active": F.lit(True)})


def companies(read: Read, ctx: RunContext) -> DataFrame:
    rows = _with_entity(read("prop_client_gen"), read).where("_h.deleteddate IS NULL")
    return rows.select(F.col("reference").alias("id"), _id(ctx, "reference"), *_dates("seconds"), "name",
                       F.nullif(F.col("no_empl").cast("string"), F.lit("")).alias("size"), F.lit("client").alias("relationship"))


def company_identities(read: Read, companies: DataFrame, ctx: RunContext) -> DataFrame:
    rows = read("prop_client_gen").where(not_blank("web_add"))
    rows = _with_entity(fk_map(rows, "reference", companies, "atlas_id", "atlas_company_id", policy="exclude"), read)
    site = linkedin_norm("web_add")
    return rows.select(F.concat(F.col("reference").cast("string"), F.lit("_website")).alias("id"), _id(ctx, "reference", site),
                       F.col("reference").alias("company_id"), "atlas_company_id", *_dates("midnight"), F.lower(site).alias("value"),
                       F.lit("website").alias("type"), F.lit(True).alias("is_primary"))


def company_contacts(read: Read, people: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    rows = fk_map(read("prop_cont_gen").where(not_blank("job_title")), "reference", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = fk_map(rows, "cur_empl", companies, "atlas_id", "atlas_company_id", policy="exclude")
    rows = _with_entity(rows, read).where("_h.deleteddate IS NULL")
    return rows.select(F.col("bisuniqueid").cast("string").alias("id"), _id(ctx, "bisuniqueid", "cur_empl"), F.col("reference").alias("person_id"),
                       "atlas_person_id", *_dates("seconds"), ctx.agency().alias("agency_id"), F.col("cur_empl").alias("company_id"),
                       "atlas_company_id", F.lit("client").alias("relationship"), F.col("job_title").alias("title"))


def person_notes(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    """Journal entries, once for every person they are linked to."""
    links = read("lk_entities_journal").select("journal_id", F.col("entity_id").alias("person_id")).distinct()
    links = fk_map(links, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    raw = F.coalesce(F.nullif(F.btrim("j_notes"), F.lit("")), F.nullif(F.btrim("j_document"), F.lit("")))
    texts = read("journal_entries").where(raw.isNotNull()).select(
        F.col("id").alias("journal_id"), clean_html(raw).alias("text"), "creator_id", iso(_ts("creation_date"), "midnight").alias("created_at"),
        iso(F.coalesce(_ts("notes_edit_date"), _ts("creation_date")), "midnight").alias("updated_at"))
    key = F.concat_ws("_", "person_id", "journal_id")
    return links.join(texts, "journal_id").select(
        key.alias("id"), _id(ctx, key), "created_at", "updated_at", "text", "person_id", "atlas_person_id",
        F.col("creator_id").cast("string").alias("created_by_id"), ctx.master().alias("created_by_atlas_id"), F.lit("manual").alias("type"))


def _clients(read: Read) -> DataFrame:
    """Client keys of either kind, reference first, with the client's reference."""
    rows = read("prop_client_gen")
    keys = union_all(*[rows.select(F.col(c).cast("string").alias("key"), F.lit(i).alias("rank"), F.col("reference"))
                       for i, c in enumerate(("reference", "client_id"))]).where("key IS NOT NULL")
    best = one_per_key(keys, [F.col("key")], F.min(F.struct("rank", "reference")).alias("best"))
    return best.select("key", F.col("best.reference").alias("company"))


def projects(read: Read, companies: DataFrame, ctx: RunContext) -> DataFrame:
    """Jobs with the smallest client on their shortlists. The export holds finished work, so all arrive closed."""
    listed = fk_map(read("prop_x_short_cand").where("job IS NOT NULL"), F.col("client").cast("string"), _clients(read), "company", "_company", "key",
                    policy="exclude")
    picked = one_per_key(listed, [F.col("job")], F.min("_company").alias("company"))
    rows = fk_map(read("prop_job_gen"), "reference", picked, "company", "company_id", "job", policy="exclude")
    rows = fk_map(rows, "company_id", companies, "atlas_id", "atlas_company_id", policy="exclude")
    rows = _with_entity(rows, read).where("_h.status IS NULL OR _h.status != 'D'")
    return rows.select(
        F.col("reference").alias("id"), _id(ctx, "reference"), *_dates("midnight"), F.col("job_title").alias("job_role"), "company_id",
        "atlas_company_id", F.lit("false").alias("public"), F.lit("project").alias("class_type"),
        iso(F.coalesce(_ts("closed_dt"), ctx.now()), "midnight").alias("closed_at"), F.lit("1").alias("owner_id"),
        ctx.master().alias("atlas_owner_id"), F.lit("closed").alias("state"), F.lit("cancelled").alias("close_reason"),
        F.col("reference").alias("job_number"))


def stages(read: Read, ctx: RunContext) -> DataFrame:
    """Shortlist, interview and placement links with the person behind the candidate key."""
    person, candidate = read("prop_person_gen"), read("prop_cand_gen")
    keys = union_all(*[df.select(F.col(c).cast("string").alias("key"), F.lit(i).alias("rank"), F.col("reference")) for i, (df, c) in enumerate(
        ((person, "reference"), (person, "person_id"), (candidate, "reference")))]).where("key IS NOT NULL")
    best = one_per_key(keys, [F.col("key")], F.min(F.struct("rank", "reference")).alias("best"))
    who = best.select("key", F.col("best.reference").alias("person"))

    def linked(table: str) -> DataFrame:
        rows = read(table).where("job IS NOT NULL")
        return fk_map(rows, F.col("candidate").cast("string"), who, "person", "person_id", "key", policy="exclude").withColumn("project_id", F.col("job"))

    company = read("prop_job_gen").select("reference", F.col("tbref").cast("string").alias("client"))
    by_client = read("prop_client_gen").select(F.col("client_id").cast("string").alias("cid"), F.col("reference").alias("company"))
    seen = union_all(*[read(t).select(F.col("candidateid").alias("person_id"), F.col("clientid").alias("company"), F.coalesce(
        _ts("enddatetime"), _ts("ivdate"), _ts("startdatetime")).alias("at")) for t in (
            "phx_previousinterviewsdatacache", "phx_upcominginterviewsdatacache")])
    last = one_per_key(seen, [F.col("person_id"), F.col("company")], F.max("at").alias("at"))
    met = fk_map(fk_map(linked("prop_x_int_cand"), "job", company, "client", "_client", "reference"), "_client", by_client, "company", "company", "cid")
    met = met.join(last, ["person_id", "company"], "left")
    ended = read("prop_assig_gen").select("assig_id", F.coalesce(_ts("filled_dt"), _ts("start_dt"), _ts("end_dt")).alias("at"))
    placed = fk_map(linked("prop_x_assig_cand"), "assignment", ended, "at", "at", "assig_id")
    parts = [(placed, "Hired", F.col("at")), (met, "Internal IV", F.col("at")), (linked("prop_x_short_cand"), "Added", ctx.now())]
    return union_all(*[df.select("person_id", "project_id", F.lit(status).alias("status"), F.coalesce(at, ctx.now()).alias("ts"))
                       for df, status, at in parts])


def tables(read: Read, ctx: RunContext, out: Outputs) -> None:
    ours, firms = out.add("people", people(read, ctx)), out.add("companies", companies(read, ctx))
    jobs = out.add("projects", projects(read, firms, ctx))
    out.add("person_identities", person_identities(read, ours, ctx))
    out.add("company_identities", company_identities(read, firms, ctx))
    out.add("company_contacts", company_contacts(read, ours, firms, ctx))
    out.add("person_notes", person_notes(read, ours, ctx))
    out.add("candidates", build_candidates_from_stages(stages(read, ctx), jobs, ours, ctx))
