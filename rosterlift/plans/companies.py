"""Companies, their contacts and their relationships."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.codes import headcount_range
from ..functions.dates import iso
from ..functions.ids import uuid_from
from ..functions.location import location_locality
from ..functions.predicates import not_blank
from ..functions.text import html_to_markdown, scrub
from ..operators.dedupe import keep_first, one_per_id
from ..operators.joins import drop_orphans, exists_flag, fk_map, keep_any, one_per_key, survivor_key

MISSING_TITLE = "Missing Title"


def build_companies(raw: DataFrame, ctx: RunContext, relationship: Column, restriction: Column,
                    placeholder: str = "Imported Contacts", scope: DataFrame | None = None) -> DataFrame:
    """raw: id, name, description, address1, address2, city, state, zip, country, headcount, added_at, modified_at,
    and what ``relationship`` and ``restriction`` are read off. One row per id, the newest."""
    named = raw.where(not_blank("name") & (F.col("name") != placeholder))
    if scope is not None:
        named = keep_any(named, "id", (scope, "company_id"))
    country = scrub("country")
    return one_per_id(named).select(
        ctx.record_id("id").alias("atlas_id"), "id", "name",
        html_to_markdown("description").alias("summary"),
        relationship.alias("relationship"),
        scrub("address1").alias("location_street_address"), scrub("city").alias("location_metro"),
        scrub("state").alias("location_region"), scrub("zip").alias("location_postal_code"),
        country.alias("location_country"),
        location_locality("address1", "address2", "city", "state", "zip", country).alias("location_locality"),
        iso("added_at").alias("created_at"), iso("modified_at").alias("updated_at"),
        restriction.alias("restriction_type"),
        headcount_range("headcount").alias("size"), ctx.agency().alias("agency_id"))


def build_company_contacts(raw: DataFrame, companies: DataFrame, people: DataFrame, ctx: RunContext,
                           relationship: Column, duplicates: DataFrame | None = None) -> DataFrame:
    """raw: id, person_id, company_id, title, added_at and what ``relationship`` is read off.

    The newest company of each person.
    """
    rows = survivor_key(raw, "person_id", duplicates) if duplicates is not None else raw
    rows = fk_map(rows, "company_id", companies, "atlas_id", "atlas_company_id", policy="exclude")
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    newest = keep_first(rows, ["person_id"], [F.col("added_at").desc_nulls_last(), F.col("id").asc()])
    return newest.select(
        "id", ctx.record_id(F.lit("companycontact"), "id").alias("atlas_id"), "person_id",
        "atlas_person_id", "company_id", "atlas_company_id", iso("added_at").alias("created_at"),
        iso("added_at").alias("updated_at"), relationship.alias("relationship"),
        F.coalesce("title", F.lit(MISSING_TITLE)).alias("title"), ctx.agency().alias("agency_id"))


def build_contacts_from_projects(links: DataFrame, positions: DataFrame, companies: DataFrame, people: DataFrame,
                                 ctx: RunContext) -> DataFrame:
    """links: person_id, company_id (contacts of a company's projects). positions: person_id, company_id, title,
    is_active.

    A contact employed at the company is a client; one company per person, those employing the person first.

    The company is a minimum per person, which is kept small before the shuffle: no task sorts its pairs for it, and ids and titles are
    looked up for the chosen pairs alone. Repeated pairs change no minimum, so they are not grouped.
    """
    pairs = drop_orphans(links.select("person_id", "company_id"), "person_id", people)
    pairs = drop_orphans(pairs, "company_id", companies)
    held = one_per_key(positions.where("is_active"), [F.col("person_id"), F.col("company_id")],
                       F.min("title").alias("title")).withColumn("_held", F.lit(True))
    rows = pairs.join(held.drop("title"), ["person_id", "company_id"], "left")
    best = rows.groupBy("person_id").agg(F.coalesce(F.min(F.when(F.col("_held"), F.col("company_id"))), F.min("company_id")).alias("company_id"))
    kept = best.join(held, ["person_id", "company_id"], "left")
    kept = fk_map(kept, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude", unique=False)
    kept = fk_map(kept, "company_id", companies, "atlas_id", "atlas_company_id", policy="exclude", unique=False)
    key = (F.lit(f"{ctx.client}_"), F.col("person_id"), F.lit("companycontact"), F.col("company_id"))
    return kept.select(
        F.concat(*[k.cast("string") for k in key]).alias("id"), uuid_from(ctx.client, *key).alias("atlas_id"),
        "person_id", "atlas_person_id", "company_id", "atlas_company_id",
        F.when(F.col("_held"), "client").otherwise("none").alias("relationship"),
        F.coalesce("title", F.lit(MISSING_TITLE)).alias("title"), ctx.agency().alias("agency_id"))


def contact_relationship(contacts: DataFrame, clients: DataFrame, key: str, client_key: str) -> DataFrame:
    """Contacts marked client when some link relation mentions them, else none."""
    flagged = exists_flag(contacts, key, clients, client_key, "_client")
    return flagged.withColumn("relationship", F.when(F.col("_client"), "client").otherwise("none")).drop("_client")


def current_position(positions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """positions: is_active, started_at, finished_at, id. Active or open-ended rows only, the newest per key."""
    live = positions.where(F.coalesce("is_active", F.lit(False)) | F.col("finished_at").isNull())
    return keep_first(live, keys, [F.col("started_at").desc_nulls_last(), F.col("id").desc()])


def build_company_relationships(raw: DataFrame, companies: DataFrame, ctx: RunContext,
                                users: DataFrame | None = None) -> DataFrame:
    """raw: id, parent_id, added_at, modified_at, created_by (a user name). Parent links between imported companies."""
    child = fk_map(raw.where("parent_id IS NOT NULL"), "id", companies, "atlas_id", "atlas_subsidiary_id",
                   policy="exclude")
    both = fk_map(child, "parent_id", companies, "atlas_id", "atlas_company_id", policy="exclude")
    if users is not None:
        by_name = one_per_key(users, [F.lower("name").alias("id")], F.min("atlas_id").alias("atlas_id"))
        both = fk_map(both, F.lower("created_by"), by_name, "atlas_id", "created_by_atlas_id",
                      default=ctx.master())
    else:
        both = both.withColumn("created_by_atlas_id", ctx.master())
    return both.select(
        uuid_from(ctx.client, F.lit("parent_"), "atlas_company_id", F.lit("_"), "atlas_subsidiary_id").alias("atlas_id"),
        F.col("id").alias("subsidiary_id"), F.col("parent_id").alias("company_id"), "atlas_subsidiary_id",
        "atlas_company_id", F.lit("parent").alias("relationship_type"), iso("added_at", "zulu").alias("created_at"),
        iso("modified_at", "zulu").alias("updated_at"), "created_by_atlas_id", ctx.agency().alias("agency_id"))
