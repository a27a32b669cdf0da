"""Candidacies: a person on a project."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.codes import code_map
from ..functions.dates import iso
from ..functions.ids import compact, expanded, uuid_from
from ..operators.dedupe import keep_first
from ..operators.history import effective_status, last_time, merge_stages
from ..operators.joins import fk_map, lookup_chain


def build_candidates(raw: DataFrame, projects: DataFrame, people: DataFrame, users: DataFrame, ctx: RunContext,
                     marks: Mapping[str, Column], history: DataFrame | None = None,
                     hired_codes: Sequence[str] = ("placed",)) -> DataFrame:
    """raw: id, project_id, person_id, owner_id, added_at and what ``marks`` are read off. history: id, status, added_at.

    ``marks`` holds the columns ``outcome`` gives; they are read off the rows that stay. One candidacy per project and
    person, the newest.

    With a history its times are looked up first, while rows are narrow, and the newest row is chosen behind the join by project, whose
    exchange serves both; an unknown person excludes all rows of its pairs, so people may follow, on the rows that stay.
    """
    newest = [F.col("added_at").desc_nulls_last(), F.col("id").desc()]
    if history is not None:
        hired = last_time(history, "id", F.lower(F.trim("status")).isin(*hired_codes), "added_at", "_hired")
        rows = fk_map(raw.join(hired, "id", "left"), "project_id", projects, "atlas_id", "atlas_project_id", policy="exclude")
        rows = keep_first(rows, ["project_id", "person_id"], newest)
        rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude", unique=False)
    else:
        rows = fk_map(raw, "project_id", projects, "atlas_id", "atlas_project_id", policy="exclude")
        rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
        rows = keep_first(rows, ["project_id", "person_id"], newest).withColumn("_hired", F.lit(None).cast("timestamp"))
    rows = fk_map(rows, "owner_id", users, "atlas_id", "atlas_owner_id", default=ctx.master())
    kind = marks["rejection_type"]
    rejected = kind.isNotNull()
    return rows.select(
        "id", ctx.record_id("id").alias("atlas_id"), iso("added_at").alias("created_at"),
        iso("added_at").alias("updated_at"), "project_id", "atlas_project_id", "person_id", "atlas_person_id",
        F.lit("Candidate").alias("class_type"), marks["rejected_at"].alias("rejected_at"),
        kind.alias("rejection_type"), marks["rejection_reason"].alias("rejection_reason"),
        F.when(rejected, F.col("owner_id")).alias("rejected_by_id"),
        F.when(rejected, F.col("atlas_owner_id")).alias("atlas_rejected_by_id"), "owner_id", "atlas_owner_id",
        marks["status"].alias("status"), iso(F.when(marks["status"] == "Hired", F.col("_hired"))).alias("hired_at"))


def build_candidates_from_history(raw: DataFrame, history: DataFrame, projects: DataFrame, people: DataFrame,
                                  users: DataFrame, ctx: RunContext, status: Mapping[str, str],
                                  rejection_type: Mapping[str, str], rejected: Sequence[str]) -> DataFrame:
    """raw: id, project_id, person_id, owner (id or name), created_at, updated_at.
    history: person_id, project_id, status, ts, event_id. users: id, name, atlas_id.

    The status shown is the last one that was not a rejection; the rejection itself comes from the latest event. One
    candidacy per project and person, the newest.
    """
    keys = ["person_id", "project_id"]
    told = effective_status(history, keys, "status", "ts", "event_id", rejected)
    kind = code_map("latest_status", rejection_type)
    told = told.select(*keys, code_map("effective_status", status, "Added").alias("status"),
                       kind.alias("rejection_type"), F.when(kind.isNotNull(), iso("latest_at", "midnight")).alias(
                           "rejected_at"))
    newest = [F.col("created_at").desc_nulls_last(), F.col("id").desc()]
    rows = keep_first(raw, ["project_id", "person_id"], newest).join(told, keys, "left")
    rows = lookup_chain(rows, "owner", users, ["id", "name"], "atlas_id", "atlas_owner_id", ctx.master())
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id")
    rows = fk_map(rows, "project_id", projects, "atlas_id", "atlas_project_id")
    refused = F.col("rejection_type").isNotNull()
    return rows.select(
        "id", uuid_from(ctx.client, "id").alias("atlas_id"), "person_id", "atlas_person_id", "project_id",
        "atlas_project_id", F.col("owner").alias("owner_id"), "atlas_owner_id",
        iso("created_at", "midnight").alias("created_at"), iso("updated_at", "midnight").alias("updated_at"),
        F.coalesce("status", F.lit("Added")).alias("status"), "rejection_type",
        F.when(refused, "other").alias("rejection_reason"),
        F.when(refused, ctx.master()).alias("atlas_rejected_by_id"), "rejected_at")


def build_candidates_from_stages(stages: DataFrame, projects: DataFrame, people: DataFrame, ctx: RunContext,
                                 ranking: Sequence[str] = ("Hired", "Internal IV", "Added")) -> DataFrame:
    """stages: person_id, project_id, status, ts, united from the vendor's link tables."""
    keys = ["person_id", "project_id"]
    rows = merge_stages(stages, keys, "status", "ts", ranking)
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = fk_map(rows, "project_id", projects, "atlas_id", "atlas_project_id", policy="exclude")
    joined_key = F.concat_ws("_", "person_id", "project_id")
    return rows.select(
        joined_key.alias("id"), uuid_from(ctx.client, joined_key).alias("atlas_id"), "person_id", "atlas_person_id",
        "project_id", "atlas_project_id", iso("ts", "midnight").alias("created_at"),
        iso("ts", "midnight").alias("updated_at"), "status", F.lit("1").alias("owner_id"),
        ctx.master().alias("atlas_owner_id"))


def build_placements(fees: DataFrame, candidates: DataFrame) -> DataFrame:
    """Fees joined to the candidacy of the same project and person; a placement is as old as its fee.

    Uuids are exchanged as bytes.
    """
    held = candidates.select("project_id", F.col("person_id").alias("candidate_id"), F.col("id").alias("_cid"),
                             compact(F.col("atlas_id")).alias("_caid"))
    ids = ["atlas_id", "atlas_project_id"]
    fees = fees.select("project_id", "candidate_id", "id", "created_at", *[compact(F.col(c)).alias(c) for c in ids])
    rows = fees.join(held, ["project_id", "candidate_id"])
    for c in (*ids, "_caid"):
        rows = rows.withColumn(c, expanded(F.col(c)))
    return rows.select(
        F.concat_ws("_", F.lit("placement"), "id").alias("id"), uuid_from("placement", "atlas_id", "_caid").alias("atlas_id"),
        "created_at",
        "project_id", "atlas_project_id", F.col("_cid").alias("candidate_id"),
        F.col("_caid").alias("atlas_candidate_id"), F.col("id").alias("project_fee_id"),
        F.col("atlas_id").alias("atlas_project_fee_id"))
