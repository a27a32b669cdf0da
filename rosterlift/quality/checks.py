"""Rules turned into checks of one table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructType

from . import predicates as P
from .contracts import LINK_TABLES, matches

FAIL, WARN = "fail", "warn"
LOCATION_FIELDS = ("location_street_address", "location_locality", "location_postal_code", "location_country")


@dataclass(frozen=True)
class Check:
    """One rule on one column.

    ``kind`` says how it is measured: ``rows`` counts rows where ``bad`` holds, ``fraction`` compares that count to
    a share of the rows, ``single`` and ``mixed`` look at the least and greatest value, ``unique`` counts repeated
    values, ``schema`` is decided already (``bad`` is the count), ``positions`` and ``pairs`` group the table.
    """

    rule: str
    column: str
    kind: str
    severity: str = FAIL
    bad: Column | int | None = None
    limit: float | None = None
    ignore_case: bool = False


def _names(rule: Any) -> list[str]:
    return list(rule) if rule else []


def compile_checks(table: str, schema: StructType, rules: Mapping[str, Any],
                   global_rules: Mapping[str, Any] | None = None) -> list[Check]:
    """The checks a table gets. A rule on an absent column is skipped; only ``required`` reports it."""
    have = set(schema.fieldNames())
    boolean = {f.name for f in schema.fields if isinstance(f.dataType, BooleanType)}
    checks: list[Check] = []
    add = checks.append
    is_link = matches(table, LINK_TABLES)

    shared = global_rules or {}
    for c in _names(shared.get("required")):
        if not (c == "atlas_id" and is_link):
            add(Check("global_required", c, "schema", bad=int(c not in have)))
    for c in _names(shared.get("not_null")):
        if c == "atlas_id" and is_link:
            continue
        if c in have:
            add(Check("global_not_null", c, "rows", bad=P.is_missing(F.col(c))))
        else:
            add(Check("global_required", c, "schema", bad=1))
    for c in _names((shared.get("iso_timestamp") or {}).get("columns")):
        if c in have:
            add(Check("global_iso_timestamp", c, "rows", bad=P.not_iso_timestamp(F.col(c))))

    for c in _names(rules.get("required")):
        add(Check("required", c, "schema", bad=int(c not in have)))
    for c in _names(rules.get("nice_to_have")):
        add(Check("nice_to_have", c, "schema", WARN, int(c not in have)))

    row_rules = {"not_null": P.is_missing, "uuid_columns": P.not_uuid, "date_ymd_columns": P.not_ymd_date,
                 "iso_timestamp": P.not_iso_timestamp, "no_html_columns": P.has_html, "email": P.not_basic_email,
                 "numeric": P.not_numeric, "url": P.not_bare_url, "trim": P.not_trimmed}
    for rule, bad in row_rules.items():
        for c in _names(rules.get(rule)):
            if c in have:
                add(Check(rule, c, "rows", bad=bad(F.col(c))))
    for c in _names(rules.get("valid_email")):
        if c in have:
            add(Check("valid_email", c, "rows", bad=P.not_strict_email(F.col(c))))
            add(Check("blocked_domain", c, "rows", bad=P.has_blocked_domain(F.col(c))))
    for c in _names(rules.get("currency")):
        if c in have:
            add(Check("currency", c, "rows", bad=P.not_three_letters(F.col(c))))
            add(Check("known_currency", c, "rows", WARN, P.unknown_currency(F.col(c))))
    for c, pattern in (rules.get("matches_regex") or {}).items():
        if c in have:
            add(Check("matches_regex", c, "rows", bad=P.not_matching(F.col(c), pattern)))
    for rule, fold in (("unique", False), ("unique_ci", True)):
        for c in _names(rules.get(rule)):
            if c in have:
                add(Check(rule, c, "unique", ignore_case=fold))
    for c, accepted in (rules.get("allowed_values") or {}).items():
        if c in have and c not in boolean:
            add(Check("allowed_values", c, "rows", bad=P.not_accepted(F.col(c), accepted)))
    for c in _names(rules.get("isBoolean")):
        if c in have:
            add(Check("is_boolean", c, "schema", bad=int(c not in boolean)))
            if c in boolean:
                add(Check("boolean_nulls", c, "rows", WARN, P.is_missing(F.col(c))))
    for c, expected in (rules.get("boolean_is") or {}).items():
        if c in have:
            add(Check("boolean_is", c, "rows", bad=P.not_bool(F.col(c), str(expected).lower() == "true")))
    for c, warn_only in (rules.get("booleanIsMixed") or {}).items():
        if c in have:
            add(Check("boolean_is_mixed", c, "mixed", WARN if warn_only is True else FAIL))
    for rule, severity in (("warn_null", WARN), ("error_null", FAIL)):
        for c, share in (rules.get(rule) or {}).items():
            if c in have:
                if not 0 <= float(share) <= 1:
                    raise ValueError(f"{rule} {c}: a fraction lies between 0 and 1, not {share}")
                add(Check(rule, c, "fraction", severity, P.is_missing(F.col(c)), float(share)))
    for c, value in (rules.get("constant") or {}).items():
        if c in have:
            expected = str(value).lower() if c in boolean else str(value)
            add(Check("constant", c, "rows", bad=P.not_equal(F.col(c), expected)))
    for rule in ("constant_any", "constant_across_table"):
        for c in _names(rules.get(rule)):
            if c in have:
                add(Check(rule, c, "single"))
    if rules.get("location_coverage"):
        fields = [c for c in LOCATION_FIELDS if c in have]
        if fields:
            add(Check("location_coverage", "location", "fraction", bad=~P.any_filled(fields),
                      limit=1 - float(rules["location_coverage"])))
    positions = rules.get("consecutive_attribute_positions")
    if positions:
        named = positions if isinstance(positions, Mapping) else {}
        attribute = named.get("attribute_id_column", "atlas_attribute_id")
        position = named.get("position_column", "position")
        if attribute in have and position in have:
            add(Check("consecutive_positions", f"{attribute},{position}", "positions"))
    if matches(table, "candidates*") and {"atlas_person_id", "atlas_project_id"} <= have:
        add(Check("candidate_duplicates", "atlas_project_id,atlas_person_id", "pairs"))
    return checks
