"""Fee types, project fees and how they are split; the agency row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.dates import iso
from ..functions.ids import uuid_from
from ..functions.money import fee_amount, share_percent
from ..functions.predicates import not_blank
from ..operators.joins import fk_map, one_per_key, with_constant
from ..sources.tables import constant_row


def build_fee_types(spark: SparkSession, ctx: RunContext, name: str = "Projected") -> DataFrame:
    return constant_row(
        spark, id=f"fee_type_{name.lower()}", created_by_id=ctx.master_id, atlas_id=uuid_from(ctx.client, F.lit(ctx.agency_id), F.lit(f"fee_type_{name.lower()}")),
        created_at=ctx.now_iso, updated_at=ctx.now_iso, name=name, created_by_atlas_id=ctx.master_id,
        agency_id=ctx.agency_id, project_fee_type="fee")


def build_agency(spark: SparkSession, ctx: RunContext) -> DataFrame:
    return constant_row(spark, atlas_id=ctx.agency_id, name=ctx.client, domain=ctx.domain, created_at=ctx.now_iso,
                        updated_at=ctx.now_iso)


def build_project_fees(raw: DataFrame, people: DataFrame, projects: DataFrame, fee_types: DataFrame, ctx: RunContext,
                       currency: str = "GBP") -> DataFrame:
    """raw: id, person_id, project_id, salary, rate, comments, added_at. The fee is the rate on the salary."""
    rows = raw.where(F.col("salary") != 0)
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = fk_map(rows, "project_id", projects, "atlas_id", "atlas_project_id", policy="exclude")
    rows = with_constant(rows, fee_types.select(F.col("atlas_id").alias("fee_type_id")))
    fee_id = F.concat(F.trim(F.col("rate").cast("string")), F.lit("_paid_"), F.col("id").cast("string"))
    amount = fee_amount("salary", "rate")
    return rows.select(
        fee_id.alias("id"), uuid_from(ctx.client, fee_id).alias("atlas_id"), "project_id", "atlas_project_id",
        F.col("person_id").alias("candidate_id"), F.col("atlas_person_id").alias("person_id"),
        iso("added_at").alias("created_at"), iso("added_at").alias("updated_at"),
        ctx.master().alias("created_by_id"), ctx.master().alias("created_by_atlas_id"),
        ctx.agency().alias("agency_id"), "fee_type_id", iso("added_at", "date").alias("fee_date"),
        amount.alias("amount"), F.lit(currency).alias("currency"), F.lit("paid").alias("project_fee_status"),
        F.when(not_blank("comments"), F.trim("comments")).otherwise("Migrated Placement Fee").alias("notes"),
        F.lit("placement").alias("category"), F.col("salary").cast("bigint").alias("payment_amount"),
        F.lit(currency).alias("payment_currency"))


def build_fee_splits(raw: DataFrame, projects: DataFrame, users: DataFrame, fee_types: DataFrame,
                     ctx: RunContext) -> DataFrame:
    """raw: id, project_id, email (of the earner), rate. Earners are found by their address."""
    address = F.nullif(F.lower(F.trim("email")), F.lit(""))
    earner = F.min(F.struct("atlas_id", "id")).alias("earner")
    by_email = one_per_key(users.where(address.isNotNull()), [address.alias("address")], earner)
    rows = fk_map(raw, F.lower(F.trim("email")), by_email, "earner", "_earner", ref_key="address", policy="exclude")
    rows = fk_map(rows, "project_id", projects, "atlas_id", "atlas_project_id", policy="exclude")
    rows = with_constant(rows, fee_types.select(F.col("atlas_id").alias("atlas_fee_type_id")))
    return rows.select(
        "id", ctx.record_id("id").alias("atlas_id"), "project_id", "atlas_project_id",
        F.col("_earner.id").alias("fee_earner_id"), F.col("_earner.atlas_id").alias("atlas_fee_earner_id"), ctx.master().alias("atlas_created_by_id"), "atlas_fee_type_id",
        share_percent("rate").alias("share"), ctx.agency().alias("agency_id"))
