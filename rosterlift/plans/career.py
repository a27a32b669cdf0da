"""Experiences and educations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.names import degree_part, field_of_study_part
from ..functions.predicates import not_blank
from ..functions.text import strip_tags
from ..operators.dedupe import keep_first
from ..operators.joins import fk_map, lookup_by_text, survivor_key


def build_experiences(raw: DataFrame, people: DataFrame, companies: DataFrame, ctx: RunContext,
                      duplicates: DataFrame | None = None) -> DataFrame:
    """raw: id, person_id, company_name, title, started_at, finished_at (text), description (HTML).

    The company is found by its name; of companies with one name the smallest id is taken, so no row multiplies.
    """
    rows = raw.where(not_blank("company_name") & (F.col("started_at") != "") & (F.col("title") != ""))
    rows = survivor_key(rows, "person_id", duplicates) if duplicates is not None else rows
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = keep_first(rows, ["id"], [F.col("started_at").desc_nulls_last(), F.col("person_id").asc()])
    rows = lookup_by_text(rows, "company_name", companies, "name",
                          {"company_id": "id", "atlas_company_id": "atlas_id"})
    return rows.select(
        "id", ctx.record_id("id").alias("atlas_id"),
        F.lit(ctx.now_iso).alias("created_at"), F.lit(ctx.now_iso).alias("updated_at"),
        F.lit("migration").alias("source"), ctx.agency().alias("agency_id"),
        F.left("started_at", F.lit(10)).alias("started_at"), F.left("finished_at", F.lit(10)).alias("finished_at"),
        F.trim("company_name").alias("company_name"), "title",
        F.nullif(strip_tags(F.coalesce("description", F.lit(""))), F.lit("")).alias("description"), "person_id",
        "atlas_person_id", "company_id", "atlas_company_id")


def build_educations(raw: DataFrame, people: DataFrame, ctx: RunContext,
                     duplicates: DataFrame | None = None, split_degree: bool = False) -> DataFrame:
    """raw: id, person_id, school, degree, field_of_study, grade, started_at, finished_at (text).

    ``split_degree``: the degree column holds ``degree, field of study``.
    """
    rows = raw.where(F.col("school") != "")
    rows = survivor_key(rows, "person_id", duplicates) if duplicates is not None else rows
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    rows = keep_first(rows, ["id"], [F.col("started_at").desc_nulls_last(), F.col("person_id").asc()])
    degree = degree_part("degree") if split_degree else F.col("degree")
    study = field_of_study_part("degree") if split_degree else F.col("field_of_study")
    return rows.select(
        "id", ctx.record_id("id").alias("atlas_id"),
        F.lit(ctx.now_iso).alias("created_at"), F.lit(ctx.now_iso).alias("updated_at"),
        F.lit("migration").alias("source"), F.left("started_at", F.lit(10)).alias("started_at"),
        F.left("finished_at", F.lit(10)).alias("finished_at"), F.col("school").alias("name"),
        degree.alias("degree"), study.alias("field_of_study"), "grade", "person_id", "atlas_person_id")
