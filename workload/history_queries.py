"""Status histories against the window and self-join SQL they replace."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterlift.functions.dates import iso
from rosterlift.operators import history
from rosterlift.operators.reshape import union_all
from rosterlift.plans.companies import contact_relationship

from .base import Tables, query, src
from .column_queries import d_iso

APPS, HISTORY, STAGES, POSTINGS, CONTACTS = (src(n) for n in ("applications", "history", "stages", "postings", "contacts"))
KEYS = ["person_id", "project_id"]


@query("h01_latest_status", f"""
SELECT person_id, project_id, status AS latest_status, {d_iso('ts')} AS latest_at FROM (SELECT *, row_number() OVER (PARTITION BY person_id, project_id ORDER BY ts DESC, event_id DESC) AS rn
FROM {HISTORY}) WHERE rn = 1""")
def _(t: Tables):
    return history.latest_status(t.history, KEYS, "status", "ts", "event_id").withColumn("latest_at", iso("latest_at"))


@query("h02_last_non_rejected", f"""
WITH ordered AS (SELECT *, row_number() OVER (PARTITION BY person_id, project_id ORDER BY ts DESC, event_id DESC) AS rn FROM {HISTORY}),
le AS (SELECT * FROM ordered WHERE rn = 1),
prev AS (SELECT h.person_id, h.project_id, h.status, row_number() OVER (PARTITION BY h.person_id, h.project_id ORDER BY h.ts DESC, h.event_id DESC) AS r2
         FROM {HISTORY} h JOIN le ON le.person_id = h.person_id AND le.project_id = h.project_id
         WHERE (h.ts, h.event_id) < (le.ts, le.event_id) AND h.status NOT IN ('error', 'click'))
SELECT le.person_id, le.project_id, le.status AS latest_status, {d_iso('le.ts')} AS latest_at,
  CASE WHEN le.status IN ('error', 'click') THEN coalesce(p.status, 'Added') ELSE le.status END AS effective_status
FROM le LEFT JOIN prev p ON p.person_id = le.person_id AND p.project_id = le.project_id AND p.r2 = 1""")
def _(t: Tables):
    told = history.effective_status(t.history, KEYS, "status", "ts", "event_id", ("error", "click"))
    return told.withColumn("latest_at", iso("latest_at"))


@query("h03_outcome", f"""
SELECT id, CASE lower(trim(status)) WHEN 'placed' THEN 'Hired' WHEN '1st interview' THEN 'Client IV' WHEN 'cv sent' THEN 'Presented' ELSE 'Added' END AS status,
  CASE lower(trim(status)) WHEN 'rejected' THEN 'by_us' WHEN 'offer rejected' THEN 'self' END AS rejection_type,
  CASE lower(trim(status)) WHEN 'offer rejected' THEN 'accepted_another_offer' WHEN 'rejected' THEN 'other' END AS rejection_reason,
  CASE WHEN lower(trim(status)) IN ('rejected', 'offer rejected') THEN {d_iso('added_at')} END AS rejected_at FROM {APPS}""")
def _(t: Tables):
    marks = history.outcome(F.lower(F.trim("status")), {"placed": "Hired", "1st interview": "Client IV", "cv sent": "Presented"},
                            {"rejected": "by_us", "offer rejected": "self"}, {"offer rejected": "accepted_another_offer"}, iso("added_at"))
    return t.applications.select("id", *[c.alias(n) for n, c in marks.items()])


@query("h04_stage_merge", f"""
SELECT project_id, candidate_id, status, {d_iso('ts')} AS at FROM (SELECT *, row_number() OVER (PARTITION BY project_id, candidate_id
  ORDER BY CASE status WHEN 'Hired' THEN 1 WHEN 'Internal IV' THEN 2 WHEN 'Added' THEN 3 ELSE 9 END, ts DESC) AS rn FROM (
  SELECT project_id, candidate_id, 'Hired' AS status, hire AS ts FROM {STAGES} WHERE hire IS NOT NULL
  UNION ALL SELECT project_id, candidate_id, 'Internal IV', interview1 FROM {STAGES} WHERE interview1 IS NOT NULL
  UNION ALL SELECT project_id, candidate_id, 'Added', added FROM {STAGES})) WHERE rn = 1""")
def _(t: Tables):
    parts = [t.stages.where(f"{c} IS NOT NULL").select("project_id", "candidate_id", F.lit(s).alias("status"), F.col(c).alias("ts"))
             for s, c in (("Hired", "hire"), ("Internal IV", "interview1"), ("Added", "added"))]
    rows = history.merge_stages(union_all(*parts), ["project_id", "candidate_id"], "status", "ts", ("Hired", "Internal IV", "Added"))
    return rows.select("project_id", "candidate_id", "status", iso("ts").alias("at"))


@query("h05_hired_at", f"""
SELECT a.id, CASE WHEN a.status = 'Placed' THEN {d_iso('p.at')} END AS hired_at FROM {APPS} a
LEFT JOIN (SELECT project_id, max(added_at) AS at FROM {APPS} WHERE lower(trim(status)) = 'placed' GROUP BY project_id) p ON p.project_id = a.project_id AND a.status = 'Placed'""")
def _(t: Tables):
    last = history.last_time(t.applications, "project_id", F.lower(F.trim("status")) == "placed", "added_at", "at")
    return t.applications.join(last, "project_id", "left").select("id", iso(F.when(F.col("status") == "Placed", F.col("at"))).alias("hired_at"))


@query("h06_placement_override", f"""
SELECT a.id, CASE WHEN p.person_id IS NOT NULL THEN 'Hired' ELSE a.status END AS status FROM {APPS} a
LEFT JOIN (SELECT DISTINCT person_id, project_id FROM {APPS} WHERE flag = 'R' AND line_status = 'F') p ON p.person_id = a.person_id AND p.project_id = a.project_id""")
def _(t: Tables):
    links = t.applications.where("flag = 'R' AND line_status = 'F'")
    return history.override_by_link(t.applications, KEYS, links, "status", "Hired").select("id", "status")


PROJECT_STATES = {"lead": ["qualifying"], "active": ["converted", "offer out"], "closed": ["placed", "cancelled", "spec cv sent"],
                  "on_hold": ["on hold", "open"]}
CLOSE_REASONS = {"cancelled": ["cancelled"], "won": ["placed"], "lead_lost": ["spec cv sent"]}


@query("h07_project_state", f"""
SELECT id, st AS state, CASE WHEN st = 'closed' THEN CASE WHEN s = 'cancelled' THEN 'cancelled' WHEN s = 'placed' THEN 'won' WHEN s = 'spec cv sent' THEN 'lead_lost' ELSE 'worked_lost' END END AS close_reason,
  CASE WHEN st = 'closed' THEN coalesce({d_iso('closed_at')}, {d_iso('added_at')}) END AS closed_at
FROM (SELECT *, CASE WHEN CAST(added_at AS DATE) < CAST('1999-01-01' AS DATE) THEN 'closed' WHEN s = 'qualifying' THEN 'lead' WHEN s IN ('converted', 'offer out') THEN 'active'
  WHEN s IN ('on hold', 'open') THEN 'on_hold' ELSE 'closed' END AS st FROM (SELECT *, lower(trim(status)) AS s FROM {POSTINGS}))""")
def _(t: Tables):
    stale = F.col("added_at").cast("date") < F.lit("1999-01-01").cast("date")
    state = history.project_state(F.col("status"), PROJECT_STATES, CLOSE_REASONS, iso("closed_at"), iso("added_at"), stale=stale)
    return t.postings.select("id", *[c.alias(n) for n, c in state.items()])


@query("h08_link_relationship", f"""
SELECT c.id, CASE WHEN p.company_id IS NOT NULL THEN 'client' ELSE 'none' END AS relationship FROM {CONTACTS} c
LEFT JOIN (SELECT DISTINCT company_id FROM {POSTINGS} WHERE status = 'Placed') p ON p.company_id = c.id""")
def _(t: Tables):
    return contact_relationship(t.contacts.select("id"), t.postings.where("status = 'Placed'"), "id", "company_id")
