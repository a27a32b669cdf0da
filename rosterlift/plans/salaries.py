"""Actual and expected salaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.dates import iso, string_to_timestamp
from ..functions.ids import uuid_from
from ..functions.money import bonus_amount, currency_code, plain_amount, salary_range, total_pay
from ..functions.predicates import not_blank
from ..operators.joins import fk_map
from ..operators.reshape import unpivot


def build_salaries_from_text(raw: DataFrame, people: DataFrame, ctx: RunContext, currency: str = "GBP") -> DataFrame:
    """raw: person_id, current_salary, expected_pay (free text), created_on, modified_on (text).

    One scan gives an actual and an expected row per person; the id holds the branch, so both stay unique.
    """
    low, high = salary_range("expected_pay")
    none = F.lit(None).cast("bigint")
    actual = not_blank("current_salary") & (F.btrim("current_salary") != "0.0")
    expected = not_blank("expected_pay") & (F.upper(F.btrim("expected_pay")) != "NA")
    branches = [
        {"value": F.when(actual, "Salary::"), "type": F.lit("actual"), "tag": F.lit("::salary::"),
         "basic_salary": plain_amount("current_salary"), "expected_salary_min": none, "expected_salary_max": none},
        {"value": F.when(expected, "Salary_expected::"), "type": F.lit("expected"), "tag": F.lit("::salary_expected::"),
         "basic_salary": none, "expected_salary_min": low, "expected_salary_max": high},
    ]
    rows = unpivot(raw, ["person_id", "created_on", "modified_on"], branches)
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    return rows.select(
        F.concat("value", F.col("person_id").cast("string")).alias("id"),
        ctx.record_id("tag", "person_id").alias("atlas_id"), "person_id", "atlas_person_id",
        string_to_timestamp("created_on").alias("created_at"), string_to_timestamp("modified_on").alias("updated_at"),
        string_to_timestamp("modified_on").alias("relevant_date"), "basic_salary", "expected_salary_min",
        "expected_salary_max", F.lit(currency).alias("currency"), F.lit("gross").alias("tax_method"),
        F.lit("total").alias("expected_salary_type"), F.lit("migration").alias("source"), "type",
        ctx.master().alias("created_by_id"), ctx.master().alias("created_by_atlas_id"), ctx.agency().alias("agency_id"))


def build_salaries_with_bonus(raw: DataFrame, people: DataFrame, ctx: RunContext) -> DataFrame:
    """raw: id, person_id, base, bonus, currency, notes, created_at, updated_at. Rows with nothing to say are dropped."""
    rows = fk_map(raw, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    changed = F.coalesce("updated_at", "created_at")
    out = rows.select(
        "id", uuid_from(ctx.client, "id", "person_id").alias("atlas_id"), iso("created_at").alias("created_at"),
        iso(changed).alias("updated_at"), ctx.agency().alias("agency_id"),
        ctx.master().alias("created_by_id"), ctx.master().alias("created_by_atlas_id"), "person_id", "atlas_person_id",
        F.col("base").cast("bigint").alias("basic_salary"),
        F.round(bonus_amount("base", "bonus")).cast("bigint").alias("bonus_salary"),
        total_pay("base", "bonus").alias("total_salary"), currency_code("currency").alias("currency"), "notes",
        F.lit("gross").alias("tax_method"), F.lit("total").alias("expected_salary_type"),
        F.lit("migration").alias("source"), F.lit("actual").alias("type"),
        iso(changed, "midnight").alias("relevant_date"))
    return out.where("basic_salary IS NOT NULL OR bonus_salary IS NOT NULL OR total_salary IS NOT NULL "
                     "OR notes IS NOT NULL")


def build_salary_rates(raw: DataFrame, people: DataFrame, ctx: RunContext, currency: str = "GBP") -> DataFrame:
    """raw: person_id, salary, day_rate, hourly_rate, added_at. One row per filled rate, each with its own id."""
    branches = [{"value": F.when(F.col(column) > 0, F.col(column)), "tax_method": F.lit(method), "tag": F.lit(tag)}
                for column, method, tag in (("salary", "gross", "salary"), ("day_rate", "daily_rate", "day"),
                                            ("hourly_rate", "hourly_rate", "hourly"))]
    rows = unpivot(raw, ["person_id", "added_at"], branches)
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    return rows.select(
        F.concat_ws("_", "tag", "person_id").alias("id"), uuid_from(ctx.client, "person_id", "tag").alias("atlas_id"),
        "person_id", "atlas_person_id", F.round("value").cast("bigint").alias("basic_salary"), "tax_method",
        iso("added_at").alias("created_at"), iso("added_at").alias("updated_at"), F.lit(currency).alias("currency"),
        F.lit("total").alias("expected_salary_type"), ctx.master().alias("created_by_id"),
        ctx.master().alias("created_by_atlas_id"), F.lit("actual").alias("type"), F.lit("migration").alias("source"))
