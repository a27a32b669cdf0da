"""Person and company identities: one row per address, number or profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.contact import (email_norm, identity_shape, is_personal_email, linkedin_norm, phone_norm, strip_host,
                                 website_norm)
from ..functions.ids import uuid_from
from ..operators.dedupe import filled_first, flag_first, keep_first, occurring_once, priority
from ..operators.joins import fk_map, survivor_key
from ..operators.reshape import explode_list, unpivot

# Class of each identity type.
CLASS_TYPES = {"email": "EmailPersonIdentity", "phone": "PhonePersonIdentity", "linkedin": "LinkedinPersonIdentity",
               "github": "SocialPersonIdentity"}


def _none() -> Column:
    return F.lit(None).cast("string")


def identity_cell(kind: str, value: Column, scope: Column, favourite: Column, source: str = "",
          reason: Column | None = None, key: Column | None = None) -> dict:
    """One branch of the unpivot. ``key`` is what the record id is made of, where that is not the value itself."""
    reason = _none() if reason is None else reason
    return {"type": F.lit(kind), "value": value, "key": value if key is None else key, "identity_type_type": scope, "favourite": favourite,
            "source_field": F.lit(source), "inactive_reason": reason}


def first_filled(*values: Column) -> Column:
    """The first value that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def build_person_identities(raw: DataFrame, people: DataFrame, ctx: RunContext,
                            duplicates: DataFrame | None = None) -> DataFrame:
    """raw: person_id, email, email2, phone, phone2, mobile, workphone, linkedin, linkedin2, email_status, has_company.

    One scan turns the wide row into identities; the first holder of a (type, value) keeps it. Identities of a
    duplicate contact go to the surviving person.
    """
    owned = survivor_key(raw, "person_id", duplicates) if duplicates is not None else raw
    owned = fk_map(owned, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    email = first_filled(email_norm("email"), email_norm("email2"))
    private = is_personal_email(email)
    profile = first_filled(linkedin_norm("linkedin"), linkedin_norm("linkedin2"))
    branches = [
        identity_cell("email", F.when(email.contains("@") & (F.length(F.trim(email)) > 3), F.lower(email)),
              F.when(~F.col("has_company") & private, "personal").otherwise("corporate"),
              ~F.col("has_company") & private, "email",
              F.when(F.col("email_status") == 2, "unsubscribed")),
        identity_cell("linkedin", F.when(profile.contains("linkedin.com"), F.lower(profile)), _none(), F.lit(False), "linkedin",
              key=profile),
    ]
    for field in ("phone", "phone2", "mobile", "workphone"):
        number = phone_norm(field)
        branches.append(identity_cell("phone", F.when(F.length(number) > 3, number),
                              F.lit("corporate" if field == "workphone" else "personal"),
                              F.lit(field == "mobile"), field))
    long = unpivot(owned, ["person_id", "atlas_person_id"], branches)
    first = [filled_first("identity_type_type"), F.col("person_id").asc(), F.col("source_field").asc(),
             F.col("key").asc()]
    return identity_table(keep_first(long, ["type", "value"], first), ctx, key="key")


def identity_table(rows: DataFrame, ctx: RunContext, key: str = "value", verified: bool = True) -> DataFrame:
    """The output columns, from rows with their owner and the columns of ``identity_cell``."""
    return rows.select(
        "atlas_person_id", "person_id", "type", "value", "identity_type_type",
        F.coalesce(*[F.when(F.col("type") == t, F.lit(c)) for t, c in CLASS_TYPES.items()]).alias("class_type"),
        ctx.agency().alias("agency_id"), ctx.master().alias("created_by_id"), F.lit("migration").alias("source"),
        F.lit(False).alias("hidden"), F.lit(False).alias("bounced"), F.lit(True).alias("active"), "favourite",
        F.lit(verified).alias("verified"), F.lit(ctx.now_iso).alias("created_at"),
        F.lit(ctx.now_iso).alias("updated_at"),
        uuid_from(ctx.client, "atlas_person_id", "type", key).alias("atlas_id"), "inactive_reason")


def build_unique_owner_identities(raw: DataFrame, people: DataFrame, ctx: RunContext) -> DataFrame:
    """raw: person_id, email, phone, mobile, linkedin. Only values that one row of the whole export holds."""
    own, yes = F.lit("personal"), F.lit(True)
    work = F.when(is_personal_email("email"), "personal").otherwise("corporate")
    branches = [
        identity_cell("email", F.when(F.trim("email") != "", F.col("email")), work, yes),
        identity_cell("phone", phone_norm("phone"), own, yes), identity_cell("phone", phone_norm("mobile"), own, yes),
        identity_cell("linkedin", F.when(F.trim("linkedin") != "", strip_host("linkedin")), own, yes),
    ]
    long = unpivot(raw, ["person_id"], branches)
    tagged = long.select(F.concat_ws("|", "type", "value").alias("key"),
                         F.struct("person_id", "type", "value", "identity_type_type", "favourite",
                                  "inactive_reason").alias("row"))
    once = occurring_once(tagged, "key", "row").select("row.*")
    owned = fk_map(once, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    return identity_table(owned, ctx).withColumn("atlas_id", uuid_from(ctx.client, "value"))


def build_routed_identities(raw: DataFrame, people: DataFrame, ctx: RunContext) -> DataFrame:
    """raw: id, person_id, value. One generic contact column; the type is read off each value."""
    typed = raw.select("id", "person_id", identity_shape("value").alias("type"), F.col("value").alias("_raw"))
    kind = F.col("type")
    normal = (F.when(kind == "email", email_norm("_raw")).when(kind == "phone", phone_norm("_raw"))
              .when(kind == "linkedin", F.lower(linkedin_norm("_raw"))))
    # unpivot, because a filter after it is not copied below the projection: each value is normalised once
    rows = unpivot(typed, ["id", "person_id"], [{"type": kind, "value": normal}])
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    scope = F.when((F.col("type") == "email") & ~is_personal_email("value"), "corporate").otherwise("personal")
    rows = rows.withColumns({"identity_type_type": scope, "favourite": F.lit(False), "inactive_reason": _none()})
    return identity_table(keep_first(rows, ["type", "value"], [F.col("id").asc()]), ctx)


def build_listed_identities(raw: DataFrame, column: str, kind: str) -> DataFrame:
    """raw: person_id and a column holding several values in one text. One normalised identity per item."""
    separators = ",;|\n\t" if kind in ("linkedin", "email") else ",;/|\n\t"
    norm = {"email": email_norm, "phone": phone_norm, "linkedin": linkedin_norm}[kind]
    items = explode_list(raw.select("person_id", column), column, "_item", separators)
    branch = {"type": F.lit(kind), "value": F.nullif(norm("_item"), F.lit(""))}
    return unpivot(items, ["person_id"], [branch]).distinct()


def two_stage_identities(rows: DataFrame) -> DataFrame:
    """rows: person_id, type, value, scope. One row per person and value, then one holder per value over all types.

    The first e-mail and phone of each person, by value, is the favourite one.
    """
    order = [F.col("scope").desc(), F.col("type").asc()]
    per_person = keep_first(rows, ["person_id", "type", "value"], order)
    flagged = flag_first(per_person, ["person_id", "type"], [F.col("value").asc()], ["person_id", "type", "value"],
                         "favourite")
    flagged = flagged.withColumn("favourite", F.col("favourite") & F.col("type").isin("email", "phone"))
    return keep_first(flagged, ["value"], [priority("type", ("email", "phone")),
                                           priority("scope", ("personal",)), F.col("person_id").asc(),
                                           F.col("type").asc()])


def build_company_identities(raw: DataFrame, companies: DataFrame, ctx: RunContext) -> DataFrame:
    """raw: company_id, phone, website, linkedin."""
    number = F.nullif(F.trim("phone"), F.lit(""))
    site, profile = website_norm("website"), linkedin_norm("linkedin")
    branches = [
        {"type": F.lit("phone"), "value": F.when(F.length(number) > 6, number), "is_primary": F.lit(False)},
        {"type": F.lit("website"), "value": F.when(site.like("%.%") & ~site.contains("linkedin.com"), site),
         "is_primary": F.lit(True)},
        {"type": F.lit("linkedin"), "value": F.when(profile.contains("linkedin.com"), profile),
         "is_primary": F.lit(False)},
    ]
    long = unpivot(raw, ["company_id"], branches)
    owned = fk_map(long, "company_id", companies, "atlas_id", "atlas_company_id", policy="exclude")
    kept = keep_first(owned, ["type", "value"], [F.col("company_id").asc()])
    return kept.select(
        ctx.record_id("company_id", "type", "value").alias("atlas_id"), "company_id",
        "atlas_company_id", "type", "value", "is_primary", F.lit(ctx.now_iso).alias("created_at"),
        F.lit(ctx.now_iso).alias("updated_at"))
