"""Loxo's spreadsheet export: two flat lists, candidates and clients, each row a person and a company."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.codes import code_map
from ..functions.dates import iso
from ..functions.ids import uuid_from
from ..functions.predicates import not_blank
from ..operators.joins import fk_map, one_per_key
from ..operators.reshape import union_all, unpivot
from ..plans.identities import CLASS_TYPES
from ..sources.sinks import Outputs

Read = Callable[[str], DataFrame]


def _at(column: str) -> Column:
    return iso(F.col(column).try_cast("timestamp"))


def _both(read: Read) -> DataFrame:
    """Rows of both lists with the relationship their company has."""
    return union_all(read("candidate").withColumn("_relationship", F.lit("target")), read("client").withColumn("_relationship", F.lit("client")))


def people(read: Read, ctx: RunContext) -> DataFrame:
    name = F.col("name")
    last = F.substring(name, F.instr(name, " ") + F.lit(1), F.length(name))
    return _both(read).select(
        F.col("id").cast("string").alias("id"), uuid_from("", "id", "name").alias("atlas_id"),
        F.split_part(name, F.lit(" "), F.lit(1)).alias("first_name"), last.alias("last_name"), ctx.master().alias("created_by_id"),
        ctx.master().alias("updated_by_id"), ctx.master().alias("created_by_atlas_id"), ctx.master().alias("updated_by_atlas_id"),
        ctx.agency().alias("agency_id"), iso(F.to_date(F.col("created_date").try_cast("timestamp"))).alias("created_at"),
        iso(F.to_date(F.col("recent_activity_date").try_cast("timestamp"))).alias("updated_at"), F.lit("active").alias("responsiveness"),
        F.lit("regular").alias("candidate_status"), F.col("location").alias("location_locality"))


def companies(read: Read, ctx: RunContext) -> DataFrame:
    """One company per row that names one; its id comes from the row id and the name."""
    return _both(read).where(not_blank("company")).select(
        "id", uuid_from("", "id", "company").alias("atlas_id"), F.col("company").alias("name"), _at("created_date").alias("created_at"),
        F.col("location").alias("location_locality"), ctx.agency().alias("agency_id"), F.col("_relationship").alias("relationship"))


def person_identities(read: Read, people: DataFrame, ctx: RunContext) -> DataFrame:
    scope = F.when(F.col("type") == "Candidate", "personal").otherwise("corporate")
    link = F.col("linkedin")
    for prefix in ("https://", "http://", "www."):
        link = F.replace(link, F.lit(prefix), F.lit(""))
    link = F.btrim(link, F.lit("/;"))
    yes, no = F.lit(True), F.lit(False)
    rows = unpivot(_both(read), ["id", "created_date", "recent_activity_date"], [
        {"kind": F.lit("email"), "value": F.when(not_blank("email"), F.col("email")), "scope": scope, "favourite": yes},
        {"kind": F.lit("phone"), "value": F.when(not_blank("phone"), F.col("phone")), "scope": scope, "favourite": yes},
        {"kind": F.lit("linkedin"), "value": F.when(link.contains("linkedin.com/in/"), link), "scope": F.lit(None).cast("string"), "favourite": no}])
    known = one_per_key(people, [F.col("id").alias("pid")], F.min("atlas_id").alias("a"))
    rows = fk_map(rows, F.col("id").cast("string"), known, "a", "atlas_person_id", "pid")
    return rows.select(
        uuid_from(ctx.client, "id", "kind", "value").alias("atlas_id"), "value", "favourite", yes.alias("active"), F.col("kind").alias("type"),
        F.col("scope").alias("identity_type_type"), code_map("kind", CLASS_TYPES).alias("class_type"), F.col("id").cast("string").alias("person_id"),
        F.lit("migration").alias("source"), ctx.master().alias("created_by_id"), no.alias("hidden"), yes.alias("verified"),
        _at("created_date").alias("created_at"), _at("recent_activity_date").alias("updated_at"), "atlas_person_id")


def company_contacts(read: Read, people: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    known = one_per_key(people, [F.col("id").alias("pid")], F.min("atlas_id").alias("a"))
    firm = one_per_key(companies, [F.col("id").alias("cid")], F.min("atlas_id").alias("a"))
    rows = fk_map(read("client"), F.col("id").cast("string"), known, "a", "atlas_person_id", "pid")
    rows = fk_map(rows, "id", firm, "a", "atlas_company_id", "cid")
    return rows.select(
        "id", F.col("id").cast("string").alias("person_id"), "atlas_person_id", uuid_from(ctx.client, F.lit("companycontact"), "id").alias("atlas_id"),
        _at("created_date").alias("created_at"), _at("recent_activity_date").alias("updated_at"), ctx.agency().alias("agency_id"),
        F.col("id").alias("company_id"), "atlas_company_id", F.lit("prospect").alias("relationship"), "title")


def tables(read: Read, ctx: RunContext, out: Outputs) -> None:
    ours, firms = out.add("people", people(read, ctx)), out.add("companies", companies(read, ctx))
    out.add("person_identities", person_identities(read, ours, ctx))
    out.add("company_contacts", company_contacts(read, ours, firms, ctx))
