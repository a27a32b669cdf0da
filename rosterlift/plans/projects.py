"""Projects, their contacts and users."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.dates import iso
from ..functions.ids import uuid_from
from ..functions.location import has_letters, location_locality, postal_digits
from ..functions.text import strip_tags
from ..operators.dedupe import on_first_holder_only
from ..operators.joins import exclude, fk_map
from ..operators.reshape import union_distinct


def build_projects(raw: DataFrame, companies: DataFrame, users: DataFrame, ctx: RunContext, contract_type: Column,
                   state: Mapping[str, Column]) -> DataFrame:
    """raw: id, linked_id, title, salary, public_description, description, owner_id, company_id, added_at, closed_at,
    address1, address2, city, state, zip, and what ``contract_type`` and ``state`` are read off.

    ``state`` holds the columns ``project_state`` gives.
    A posting that another one links to is the linked posting's copy and is left out.
    """
    rows = exclude(raw, "id", raw, "linked_id")
    rows = fk_map(rows, "company_id", companies, "atlas_id", "atlas_company_id", policy="exclude")
    rows = fk_map(rows, "owner_id", users, "atlas_id", "atlas_owner_id", default=ctx.master())
    return rows.select(
        ctx.record_id("id").alias("atlas_id"), "id", iso("added_at").alias("created_at"),
        iso("added_at").alias("updated_at"), state["closed_at"].alias("closed_at"), F.col("title").alias("job_role"),
        contract_type.alias("contract_type"), "salary",
        strip_tags("public_description").alias("job_description"), strip_tags("description").alias("notes"),
        "owner_id", "atlas_owner_id", "company_id", "atlas_company_id", state["state"].alias("state"),
        state["close_reason"].alias("close_reason"),
        location_locality("address1", "address2", "city", "state", "zip").alias("location_locality"),
        has_letters("address1").alias("location_street_address"), has_letters("city").alias("location_metro"),
        has_letters("state").alias("location_region"), postal_digits("zip").alias("location_postal_code"),
        F.col("id").alias("job_number"), F.lit("project").alias("class_type"))


def unique_job_numbers(projects: DataFrame) -> DataFrame:
    """A job number shared by several projects stays on the oldest one."""
    return on_first_holder_only(projects, "job_number", [F.col("created_at").asc_nulls_last(), F.col("id").asc()],
                                ["id"])


def build_project_company_contacts(raw: DataFrame, contacts: DataFrame, projects: DataFrame) -> DataFrame:
    """raw: project_id, person_id. contacts: id, atlas_id, person_id, one row per person."""
    by_person = contacts.select(F.col("person_id").alias("id"), F.struct("id", "atlas_id").alias("_contact"))
    rows = fk_map(raw, "person_id", by_person, "_contact", "_contact", policy="exclude")
    rows = fk_map(rows, "project_id", projects, "atlas_id", "atlas_project_id", policy="exclude")
    return rows.select("project_id", "atlas_project_id", "person_id",
                       F.col("_contact.id").alias("company_contact_id"),
                       F.col("_contact.atlas_id").alias("atlas_company_contact_id"))


def build_project_users(team: DataFrame, owners: DataFrame, projects: DataFrame, users: DataFrame,
                        ctx: RunContext) -> DataFrame:
    """team, owners: project_id, user_id. Every user on a project once."""
    rows = union_distinct(team.select("project_id", "user_id"), owners.select("project_id", "user_id"))
    rows = fk_map(rows, "project_id", projects, "atlas_id", "atlas_project_id", policy="exclude")
    rows = fk_map(rows, "user_id", users, "atlas_id", "atlas_user_id", policy="exclude")
    return rows.select(
        F.concat_ws("_", "project_id", "user_id").alias("id"),
        uuid_from(ctx.client, "project_id", "user_id").alias("atlas_id"), F.lit(ctx.midnight_iso).alias("created_at"),
        F.lit(ctx.midnight_iso).alias("updated_at"), ctx.agency().alias("agency_id"), "project_id",
        "atlas_project_id", "user_id", "atlas_user_id")
