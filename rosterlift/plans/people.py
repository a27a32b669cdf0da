"""Users, people, duplicates and import scope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.contact import in_domain, repair_email
from ..functions.dates import iso
from ..functions.ids import uuid_from
from ..functions.location import street_address
from ..functions.text import scrub, sections
from ..operators.dedupe import filled_first, keep_first, one_per_id
from ..operators.joins import exclude, fk_map, keep_any, match_any_key, one_per_key


def build_users(raw: DataFrame, ctx: RunContext, prior: DataFrame | None = None) -> DataFrame:
    """raw: id, first_name, last_name, email, added_at, modified_at. prior: atlas_id, email, name, status.

    Staff of the agency's own domain, one per repaired address; ids of earlier runs are kept.
    """
    staff = raw.where(in_domain("email", ctx.domain)).select(
        "id",
        ctx.record_id("id").alias("atlas_id"),
        F.concat("first_name", F.lit(" "), "last_name").alias("name"),
        iso("added_at", "midnight_zulu").alias("created_at"),
        iso("modified_at").alias("updated_at"),
        repair_email("email").alias("email"),
        "added_at")
    newest = keep_first(staff, ["email"], [F.col("added_at").desc_nulls_last(), F.col("id").asc()])
    if prior is None:
        known = newest.withColumns({"_id": F.lit(None).cast("string"), "_name": F.lit(None).cast("string"),
                                    "_status": F.lit(None).cast("string")})
    else:
        earlier = one_per_key(prior.where("email IS NOT NULL"), [F.lower("email").alias("_email")],
                              F.min(F.struct("atlas_id", "name", "status")).alias("_p"))
        known = newest.join(earlier, F.lower("email") == F.col("_email"), "left").withColumns(
            {"_id": F.col("_p.atlas_id"), "_name": F.col("_p.name"), "_status": F.col("_p.status")})
    return known.select(
        "id", F.coalesce("_id", "atlas_id").alias("atlas_id"),
        F.coalesce(F.nullif(F.trim("_name"), F.lit("")), F.nullif(F.trim("name"), F.lit("")), "email").alias("name"),
        "created_at", "updated_at", "email", F.coalesce("_status", F.lit("disabled")).alias("status"))


def import_scope(ids: DataFrame, key: str, activity: Sequence[tuple[DataFrame, str]], name: str,
                 enabled: bool = True) -> DataFrame:
    """Ids worth importing: those some activity table mentions. Switched off, every id."""
    kept = keep_any(ids, key, *activity) if enabled else ids
    return kept.select(F.col(key).alias(name))


def duplicate_people(contacts: DataFrame, client_ids: DataFrame, client_key: str = "id") -> DataFrame:
    """contacts: id, linked_id. A contact that is also a candidate, with the candidate that survives."""
    linked = contacts.where("linked_id IS NOT NULL")
    return keep_any(linked, "id", (client_ids, client_key)).select(
        F.col("id").alias("contact_id"), F.col("linked_id").alias("candidate_id"))


def build_people(raw: DataFrame, ctx: RunContext, scope: DataFrame | None = None, duplicates: DataFrame | None = None,
                 users: DataFrame | None = None) -> DataFrame:
    """raw: id, first_name, last_name, added_at, modified_at, address1, address2, city, state, zip, country.

    One row per id, the newest.
    """
    if scope is not None:
        raw = keep_any(raw, "id", (scope, "person_id"))
    clean = one_per_id(raw).select(
        ctx.record_id("id").alias("atlas_id"), "id", "first_name", "last_name",
        iso("modified_at").alias("updated_at"), iso("added_at").alias("created_at"),
        F.lit("regular").alias("candidate_status"), F.lit("active").alias("responsiveness"),
        street_address(scrub("address1"), scrub("address2")).alias("location_street_address"),
        scrub("city").alias("location_locality"), scrub("state").alias("location_region"),
        scrub("zip").alias("location_postal_code"), scrub("country").alias("location_country"),
        F.lit(None).cast("string").alias("created_by_id"), F.lit(None).cast("string").alias("updated_by_id"),
        ctx.master().alias("created_by_atlas_id"), ctx.master().alias("updated_by_atlas_id"),
        ctx.agency().alias("agency_id"))
    if duplicates is not None:
        clean = exclude(clean, "id", duplicates, "contact_id")
    if users is not None:
        clean = exclude(clean, "id", users)
    return clean


def build_people_from_two_lists(candidates: DataFrame, contacts: DataFrame, ctx: RunContext,
                                contact_prefix: str = "cc") -> DataFrame:
    """candidates, contacts: id (text), first_name, last_name, email, phone, linkedin, street, city, state, country,
    created_on, updated_on (ISO text), created_by.

    Candidates, each with the smallest contact that shares an address, number or profile, then the contacts no
    candidate matches.
    """
    keys = [("email", F.lower(F.trim("email")), F.lower(F.trim("email"))),
            ("phone", F.trim("phone"), F.trim("phone")),
            ("linkedin", F.lower(F.trim("linkedin")), F.lower(F.trim("linkedin")))]
    matches = match_any_key(candidates, "id", contacts, "id", keys)
    matched_contacts = match_any_key(contacts, "id", candidates, "id", keys)
    side_a = candidates.join(matches, "id", "left").select(
        F.col("id"), F.col("id").alias("candidate_id"), F.col("match_id").alias("contact_id"),
        *_person_columns("street"))
    whole = F.concat_ws(" ", F.coalesce("street", F.lit("")), F.coalesce("city", F.lit("")),
                        F.coalesce("state", F.lit("")))
    side_b = exclude(contacts, "id", matched_contacts).select(
        F.concat(F.lit(contact_prefix), "id").alias("id"), F.lit(None).cast("string").alias("candidate_id"),
        F.col("id").alias("contact_id"), *_person_columns(F.trim(whole)))
    people = side_a.unionByName(side_b)
    return people.select(
        "id", "candidate_id", "contact_id", "first_name", "last_name",
        uuid_from(ctx.client, "id").alias("atlas_id"), "created_at", "updated_at",
        "created_by_id", uuid_from(ctx.client, "created_by_id").alias("created_by_atlas_id"),
        F.col("created_by_id").alias("updated_by_id"),
        uuid_from(ctx.client, "created_by_id").alias("updated_by_atlas_id"),
        F.lit("active").alias("responsiveness"), F.lit("regular").alias("candidate_status"),
        "location_street_address",
        F.when(F.coalesce("location_locality", F.lit("")) == "",
               F.trim(F.concat("location_metro", F.lit(" "), "location_country")))
        .otherwise(F.col("location_locality")).alias("location_locality"),
        "location_metro", "location_region", "location_country", ctx.agency().alias("agency_id"))


def _person_columns(locality: Column | str) -> list[Column]:
    place = F.col(locality) if isinstance(locality, str) else locality
    return [F.col("first_name"), F.col("last_name"), F.col("created_on").alias("created_at"),
            F.col("updated_on").alias("updated_at"), F.col("created_by").alias("created_by_id"),
            F.col("street").alias("location_street_address"), place.alias("location_locality"),
            F.col("city").alias("location_metro"), F.col("state").alias("location_region"),
            F.col("country").alias("location_country")]


def people_overview(raw: DataFrame, people: DataFrame, labels: Sequence[tuple[str, str]]) -> DataFrame:
    """Sectioned profile text per person; people without any section are left out."""
    body = sections([(label, F.col(column)) for label, column in labels])
    rows = raw.select("id", F.nullif(body, F.lit("")).alias("overview")).where("overview IS NOT NULL")
    return fk_map(rows, "id", people, "atlas_id", "atlas_person_id", policy="exclude")


def build_headlines(experiences: DataFrame) -> DataFrame:
    """The current experience of each person: open-ended first, then the latest start."""
    first = [F.col("finished_at").isNull().desc(), F.col("started_at").desc_nulls_last(), F.col("id").asc()]
    return keep_first(experiences, ["person_id"], first).select(
        "person_id", "atlas_person_id", F.col("title").alias("headline"), "company_name", "started_at")


def preferred_address(addresses: DataFrame, owner: str, street: str, tiebreak: str) -> DataFrame:
    """One address per owner, those with a street first."""
    return keep_first(addresses, [owner], [filled_first(F.trim(F.col(street))), F.col(tiebreak).asc()])
