"""Business-development opportunities and their stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.dates import iso
from ..functions.ids import uuid_from
from ..operators.joins import fk_map
from ..sources.tables import literal_relation

# The default stages in order, as the target system names them.
DEFAULT_STAGES = ("identitied", "Purusing", "initial_request", "late_stage", "converted")


def build_opportunity_stages(spark: SparkSession, ctx: RunContext,
                             stages: Sequence[str] = DEFAULT_STAGES) -> DataFrame:
    rows = literal_relation(spark, ("name", "position"), [(s, i) for i, s in enumerate(stages, start=1)])
    return rows.select(
        F.col("position").cast("string").alias("id"), uuid_from(ctx.client, F.lit("stage_"), "name").alias("atlas_id"),
        ctx.master().alias("created_by_id"), ctx.master().alias("atlas_created_by_id"), "name", "position",
        F.lit("default_stage").alias("type"))


def build_opportunities(raw: DataFrame, users: DataFrame, stages: DataFrame, ctx: RunContext) -> DataFrame:
    """raw: id, name, owner_id, stage, is_open, added_at. Open opportunities only."""
    rows = fk_map(raw.where("is_open"), "owner_id", users, "atlas_id", "atlas_owner_id", default=ctx.master())
    rows = fk_map(rows, "stage", stages, "id", "stage_id", ref_key="name", policy="exclude")
    return rows.select(
        "id", uuid_from(ctx.client, F.lit("opportunity_"), "id").alias("atlas_id"), iso("added_at").alias("created_at"),
        iso("added_at").alias("updated_at"), "name", F.lit("regular").alias("type"),
        ctx.master().alias("atlas_created_by_id"), "stage_id", "owner_id", "atlas_owner_id",
        F.lit(True).alias("manual_named"))


def build_opportunity_members(raw: DataFrame, opportunities: DataFrame, members: DataFrame, ctx: RunContext,
                              entity: str) -> DataFrame:
    """raw: opportunity_id, member_id, added_at. People or companies of an imported opportunity."""
    rows = fk_map(raw, "opportunity_id", opportunities, "atlas_id", "atlas_opportunity_id", policy="exclude")
    rows = fk_map(rows, "member_id", members, "atlas_id", f"atlas_{entity}_id", policy="exclude")
    key = F.concat_ws("_", "opportunity_id", "member_id")
    return rows.select(
        key.alias("id"), uuid_from(ctx.client, F.lit(f"{entity}_"), key).alias("atlas_id"),
        iso("added_at").alias("created_at"), iso("added_at").alias("updated_at"),
        F.col("member_id").alias(f"{entity}_id"), f"atlas_{entity}_id", "opportunity_id", "atlas_opportunity_id",
        ctx.master().alias("created_by_id"), ctx.master().alias("atlas_created_by_id"))
