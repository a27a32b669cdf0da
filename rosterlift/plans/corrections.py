"""Corrections after a first import."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.dates import iso
from ..functions.predicates import not_blank
from ..functions.text import comma_cleanup, strip_tags
from ..operators.chains import survivors
from ..operators.joins import fk_map
from ..operators.reshape import unpivot


def merged_people(raw: DataFrame, people: DataFrame) -> DataFrame:
    """raw: id, previous_id, email, linkedin. People the vendor merged, with the ids of both sides.

    ``surviving_person_id`` follows merges of the merged person to the last one (see ``survivors``).
    """
    rows = raw.where("previous_id IS NOT NULL")
    ends = survivors(rows, "previous_id", "id").select("previous_id", F.col("id").alias("_end"))
    rows = fk_map(rows, "previous_id", people, "atlas_id", "atlas_original_person_id")
    rows = fk_map(rows, "id", people, "atlas_id", "atlas_merge_person_id")
    rows = fk_map(rows, "previous_id", ends, "_end", "surviving_person_id", "previous_id", default=F.col("previous_id"))
    rows = fk_map(rows, "surviving_person_id", people, "atlas_id", "atlas_surviving_person_id")
    return rows.select(F.col("previous_id").alias("original_person_id"), F.col("id").alias("merge_person_id"),
                       "atlas_original_person_id", "atlas_merge_person_id", "surviving_person_id", "atlas_surviving_person_id",
                       F.col("linkedin").alias("linkedin_url"), "email")


def corrected_locations(people: DataFrame, parsed: DataFrame, entered: DataFrame) -> DataFrame:
    """parsed, entered: person_id, postcode, line1, line2, state, country, one row per person. Entered values win."""
    parts = ("line1", "line2", "state", "postcode", "country")

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col("person_id").alias("id"), F.struct(*parts).alias(name))

    rows = people.select(F.col("id").alias("person_id"), F.col("atlas_id").alias("atlas_person_id"))
    rows = fk_map(rows, "person_id", packed(parsed, "_p"), "_p", "_p")
    rows = fk_map(rows, "person_id", packed(entered, "_e"), "_e", "_e")
    best = {p: F.coalesce(F.col(f"_e.{p}"), F.col(f"_p.{p}")) for p in parts}
    line = F.concat_ws(",", *[F.coalesce(best[p], F.lit("")) for p in parts])
    return rows.select(
        "person_id", "atlas_person_id", best["postcode"].alias("location_postal_code"),
        best["line1"].alias("location_street_address"), best["line2"].alias("location_address_line_2"),
        best["state"].alias("location_metro"), best["country"].alias("location_country"),
        comma_cleanup(line).alias("location_locality"))


def repaired_notes(raw: DataFrame, people: DataFrame, users: DataFrame, ctx: RunContext) -> DataFrame:
    """raw: id, person_id, created_by_id, text (HTML), created_at."""
    clean = F.replace(strip_tags("text"), F.lit("&nbsp;"), F.lit(" "))
    rows = unpivot(raw, ["id", "person_id", "created_by_id", "created_at"], [{"value": clean}]).where(not_blank("value"))
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id")
    rows = fk_map(rows, "created_by_id", users, "atlas_id", "created_by_atlas_id", default=ctx.master())
    return rows.select(
        F.col("id").cast("string").alias("id"), F.col("id").cast("string").alias("atlas_id"), "person_id",
        "atlas_person_id", iso("created_at", "zulu").alias("created_at"), iso("created_at", "zulu").alias("updated_at"),
        "created_by_id", "created_by_atlas_id", F.lit("manual").alias("type"), F.col("value").alias("text"))
