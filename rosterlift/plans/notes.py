"""Notes on people and companies, and meetings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.dates import is_past, iso
from ..functions.ids import uuid_from
from ..functions.predicates import in_filter, not_blank
from ..functions.text import CRLF, clean_html, email_note, strip_tags
from ..operators.dedupe import keep_first
from ..operators.joins import fk_map, nearest_in_time, survivor_key
from ..operators.numbering import number_within
from ..operators.reshape import ordered_text, union_all, unpivot

# Comment actions that are mail traffic, not notes.
MAIL_ACTIONS = ("mail merge", "email/linkedin message", "email updated", "out-bound email")

# Channel types that name a person, and those that name a project.
PERSON_CHANNELS = ("person", "people", "candidate", "contact")
PROJECT_CHANNELS = ("assignment", "brief", "project")


def _with_people(rows: DataFrame, people: DataFrame, users: DataFrame, ctx: RunContext,
                 duplicates: DataFrame | None = None) -> DataFrame:
    rows = survivor_key(rows, "person_id", duplicates) if duplicates is not None else rows
    rows = fk_map(rows, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    return fk_map(rows, "created_by_id", users, "atlas_id", "created_by_atlas_id", default=ctx.master())


def build_person_notes(raw: DataFrame, people: DataFrame, users: DataFrame, ctx: RunContext,
                       duplicates: DataFrame | None = None) -> DataFrame:
    """raw: id, person_id, created_by_id, comments (HTML), action, added_at. Configured note actions only."""
    action = F.lower(F.trim("action"))
    rows = raw.where((F.col("comments") != "") & ~action.isin(*MAIL_ACTIONS)
                     & in_filter("action", ctx.filters.get("notes")))
    rows = _with_people(rows, people, users, ctx, duplicates)
    rows = keep_first(rows, ["id"], [F.col("person_id").asc()])
    return rows.select(
        "id", ctx.record_id("id").alias("atlas_id"), "person_id", "atlas_person_id",
        "created_by_id", "created_by_atlas_id", "action", strip_tags("comments", " ").alias("text"),
        iso("added_at").alias("created_at"), iso("added_at").alias("updated_at"), F.lit("manual").alias("type"))


def build_form_notes(answers: DataFrame, people: DataFrame, ctx: RunContext) -> DataFrame:
    """answers: form_id, person_id, title, question, answer. One note per form, answers in question order."""
    filled = answers.where(not_blank("answer"))
    line = F.concat(F.lit("- "), F.trim("question"), F.lit(": "), F.trim("answer"))
    body = ordered_text(filled.withColumn("_q", F.trim("question")), ["person_id", "form_id", "title"],
                        ["_q"], line, "\n", "_answers")
    rows = fk_map(body, "person_id", people, "atlas_id", "atlas_person_id", policy="exclude")
    return rows.select(
        F.concat(F.lit("form_"), F.col("form_id").cast("string")).alias("id"),
        uuid_from(ctx.client, "form_id", "person_id").alias("atlas_id"), "person_id", "atlas_person_id",
        ctx.master().alias("created_by_id"), ctx.master().alias("created_by_atlas_id"),
        F.concat("title", F.lit("\n\n"), "_answers").alias("text"),
        F.lit("manual").alias("type"), F.lit(ctx.midnight_iso).alias("created_at"),
        F.lit(ctx.midnight_iso).alias("updated_at"))


def build_email_notes(emails: DataFrame, links: DataFrame, people: DataFrame, users: DataFrame,
                      ctx: RunContext) -> DataFrame:
    """emails: id, created_by_id, sender, receiver, subject, body, created_at. links: email_id, person_id, repeated or not."""
    links = links.select("email_id", "person_id").distinct()
    rows = links.join(emails, links["email_id"] == emails["id"]).drop("email_id")
    rows = _with_people(rows, people, users, ctx)
    note = email_note("sender", "receiver", "subject", "body")
    return rows.select(
        "id", uuid_from(ctx.client, "id", "person_id").alias("atlas_id"), iso("created_at", "midnight").alias(
            "created_at"), iso("created_at", "midnight").alias("updated_at"), note.alias("text"), "person_id",
        "atlas_person_id", "created_by_id", "created_by_atlas_id", F.lit("manual").alias("type"))


def build_linked_notes(links: Sequence[DataFrame], notes: DataFrame, people: DataFrame, users: DataFrame,
                       ctx: RunContext) -> DataFrame:
    """links: note_id, person_id, from several link tables. notes: id, created_by_id, text, kind, created_at.

    A note on several people becomes one row per person, numbered within the note.
    """
    pairs = union_all(*[x.select("note_id", "person_id") for x in links]).distinct()
    numbered = number_within(pairs, ["note_id"], ["person_id"], "_n")
    rows = numbered.join(notes.withColumnRenamed("id", "note_id"), "note_id")
    rows = _with_people(rows.where(not_blank("text")), people, users, ctx)
    return rows.select(
        F.concat_ws("_", "note_id", "_n").alias("id"),
        uuid_from(ctx.client, "note_id", "person_id", F.lit(ctx.client)).alias("atlas_id"), "person_id",
        "atlas_person_id", iso("created_at").alias("created_at"), iso("created_at").alias("updated_at"),
        "created_by_id", "created_by_atlas_id",
        F.when(F.col("kind") == "Phone call", "phone_call").otherwise("manual").alias("type"), "text",
        F.col("note_id").alias("source_note_id"))


def build_section_notes(raw: DataFrame, owners: DataFrame, ctx: RunContext, sections: Sequence[tuple[str, str, str]],
                        entity: str, users: DataFrame | None = None) -> DataFrame:
    """raw: the owner's id (``company_id``, ``person_id``), added_at, modified_at, one HTML column per section, and
    created_by_id where ``users`` are given.

    ``sections``: (id tag, label, column). One scan gives one note per filled section, the label on its own line.
    """
    owner, atlas_owner = f"{entity}_id", f"atlas_{entity}_id"
    branches = []
    for tag, label, column in sections:
        body = F.nullif(clean_html(F.col(column).cast("string")), F.lit(""))
        branches.append({"tag": F.lit(tag), "column": F.lit(column), "value": F.concat(F.lit(f"{label}:{CRLF}"), body)})
    author = ["created_by_id"] if users is not None else []
    rows = unpivot(raw, [owner, "added_at", "modified_at", *author], branches)
    rows = fk_map(rows, owner, owners, "atlas_id", atlas_owner, policy="exclude")
    if users is not None:
        rows = fk_map(rows, "created_by_id", users, "atlas_id", "created_by_atlas_id", default=ctx.master())
    else:
        rows = rows.withColumns({"created_by_id": F.lit(None).cast("string"), "created_by_atlas_id": ctx.master()})
    return rows.select(
        F.concat_ws("_", "tag", owner).alias("id"), ctx.record_id(owner, F.lit("::"), "column").alias("atlas_id"), owner,
        atlas_owner, F.col("value").alias("text"), F.lit("manual").alias("type"), iso("added_at").alias("created_at"),
        iso("modified_at").alias("updated_at"), "created_by_id", "created_by_atlas_id")


def build_meetings(raw: DataFrame, people: DataFrame, users: DataFrame, ctx: RunContext,
                   duplicates: DataFrame | None = None) -> DataFrame:
    """raw: id, person_id, created_by_id, comments (HTML), action, added_at. Configured meeting actions only."""
    rows = raw.where(in_filter("action", ctx.filters.get("meetings")))
    rows = _with_people(rows, people, users, ctx, duplicates)
    rows = keep_first(rows, ["id"], [F.col("person_id").asc()])
    return rows.select(
        "id", ctx.record_id("id").alias("atlas_id"), "person_id", "atlas_person_id",
        "created_by_id", "created_by_atlas_id", "action", strip_tags("comments", " ").alias("notes"),
        F.lit("migrated meeting").alias("name"), iso("added_at").alias("created_at"),
        iso("added_at").alias("updated_at"), F.lit("completed").alias("status"))


def build_channel_meetings(raw: DataFrame, candidacies: DataFrame, people: DataFrame, users: DataFrame,
                           ctx: RunContext) -> DataFrame:
    """raw: id, created_by_id, channel_type, channel_id, details, start_at, end_at, created_at, updated_at.
    candidacies: id, project_id, person_id, created_at.

    A meeting on a person belongs to that person; one on a project to the candidate added nearest to it in time.
    """
    channel = F.lower(F.coalesce("channel_type", F.lit("")))
    keyed = raw.where("channel_id IS NOT NULL")
    direct = keyed.where(channel.isin(*PERSON_CHANNELS)).withColumn("person_id", F.col("channel_id"))
    on_project = keyed.where(channel.isin(*PROJECT_CHANNELS)).withColumn("_mt", F.coalesce("start_at", "created_at"))
    nearest = nearest_in_time(on_project, "channel_id", "_mt", candidacies, "created_at", "id", "_cand",
                              right_group="project_id")
    resolved = fk_map(nearest, "_cand", candidacies, "person_id", "person_id", policy="exclude")
    rows = direct.unionByName(resolved.select(*direct.columns))
    rows = _with_people(rows, people, users, ctx)
    return rows.select(
        "id", uuid_from(ctx.client, "id").alias("atlas_id"), "person_id", "atlas_person_id", "created_by_id",
        "created_by_atlas_id", F.lit("meeting").alias("action"),
        strip_tags(F.coalesce("details", F.lit("")), " ").alias("notes"), F.lit("migrated meeting").alias("name"),
        iso(F.coalesce("created_at", "start_at")).alias("created_at"),
        iso(F.coalesce("updated_at", "end_at")).alias("updated_at"),
        F.when(is_past("end_at", ctx.now()), "completed").otherwise("planned").alias("status"))
