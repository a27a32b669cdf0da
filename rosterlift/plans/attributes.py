"""Custom attributes, their options and the values records hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.ids import uuid_from
from ..functions.text import label_slug
from ..operators.joins import fk_map, one_per_key
from ..operators.numbering import number_within
from ..sources.tables import literal_relation


def build_custom_attributes(spark: SparkSession, attributes: Sequence[tuple[str, str, bool]],
                            ctx: RunContext) -> DataFrame:
    """``attributes``: (name, record kind, multiple values). The alias is the name as a slug."""
    rows = literal_relation(spark, ("name", "of", "multiple_values"), attributes)
    return rows.select(
        label_slug("name").alias("id"), label_slug("name").alias("alias"), uuid_from(ctx.client, "name").alias("atlas_id"), "name",
        F.lit(ctx.midnight_iso).alias("created_at"), F.lit(ctx.midnight_iso).alias("updated_at"),
        ctx.agency().alias("agency_id"), "multiple_values", "of", F.lit("options").alias("type"),
        F.lit(False).alias("ai"))


def build_attribute_options(values: DataFrame, attributes: DataFrame, ctx: RunContext) -> DataFrame:
    """values: alias, value, distinct pairs. Options numbered 1..n in value order within their attribute."""
    rows = values.join(attributes.select("alias", F.col("atlas_id").alias("atlas_attribute_id")), "alias")
    numbered = number_within(rows, ["atlas_attribute_id"], ["value"])
    return numbered.select(
        F.concat_ws("_", "alias", "value").alias("id"), uuid_from(ctx.client, "alias", "value").alias("atlas_id"),
        "atlas_attribute_id", "value", "position", F.lit(ctx.midnight_iso).alias("created_at"),
        F.lit(ctx.midnight_iso).alias("updated_at"), ctx.agency().alias("agency_id"))


def build_attribute_values(held: DataFrame, options: DataFrame, attributes: DataFrame, owners: DataFrame,
                           ctx: RunContext, entity: str, ignore_case: bool = False) -> DataFrame:
    """held: owner_id, alias, value. One row per record, attribute and option; ``entity`` names the owner columns.

    The record kind (person, company, project, meeting) is a parameter, not four jobs.
    """
    def norm(column: str):
        return F.lower(column) if ignore_case else F.col(column)

    by_alias = attributes.select("alias", F.col("atlas_id").alias("atlas_custom_attribute_id"))
    choices = one_per_key(options, [F.col("atlas_attribute_id").alias("atlas_custom_attribute_id"), norm("value").alias("_v")],
                          F.min("atlas_id").alias("atlas_option_id"))
    rows = (held.where("value IS NOT NULL AND value <> ''").join(by_alias, "alias")
            .withColumn("_v", norm("value")).join(choices, ["atlas_custom_attribute_id", "_v"]))
    rows = fk_map(rows, "owner_id", owners, "atlas_id", "_owner", policy="exclude")
    rows = rows.select("owner_id", "_owner", "atlas_custom_attribute_id", "atlas_option_id").distinct()
    return rows.select(
        uuid_from(ctx.client, "_owner", "atlas_custom_attribute_id", "atlas_option_id").alias("atlas_id"),
        F.col("owner_id").alias(f"{entity}_id"), F.col("_owner").alias(f"atlas_{entity}_id"),
        "atlas_custom_attribute_id", "atlas_option_id", F.lit(ctx.midnight_iso).alias("created_at"),
        F.lit(ctx.midnight_iso).alias("updated_at"))
