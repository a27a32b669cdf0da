"""Contracts of the canonical tables: which columns a table has and what their values look like.

A contract is a plain mapping, so a rules file of the same shape (``load_rules``) can replace it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from fnmatch import fnmatchcase
from typing import Any

GLOBAL_RULES: dict[str, Any] = {
    "required": ["atlas_id"],
    "nice_to_have": ["created_at", "updated_at"],
    "iso_timestamp": {"columns": ["created_at", "updated_at"]},
}

# Tables whose rows are links and carry no id of their own.
LINK_TABLES = "project_company_contacts*"


# The contracts, in the order in which a table looks for its own.
CONTRACTS: dict[str, dict[str, Any]] = {
    "person_custom_attribute_values*": {
        "required": ["atlas_id", "person_id", "atlas_person_id", "atlas_custom_attribute_id", "atlas_option_id"],
        "not_null": ["atlas_id", "person_id", "atlas_person_id", "atlas_custom_attribute_id", "atlas_option_id"],
        "nice_to_have": ["id", "value"],
        "uuid_columns": ["atlas_id", "atlas_person_id", "atlas_custom_attribute_id", "atlas_option_id"],
        "unique": ["id", "atlas_id"],
    },
    "company_custom_attribute_values*": {
        "required": ["atlas_id", "company_id", "atlas_company_id", "atlas_custom_attribute_id", "atlas_option_id"],
        "not_null": ["atlas_id", "company_id", "atlas_company_id", "atlas_custom_attribute_id", "atlas_option_id"],
        "nice_to_have": ["id", "value"],
        "uuid_columns": ["atlas_id", "atlas_company_id", "atlas_custom_attribute_id", "atlas_option_id"],
        "unique": ["id", "atlas_id"],
    },
    "meeting_custom_attribute_values*": {
        "required": ["atlas_id", "atlas_meeting_id", "atlas_custom_attribute_id", "atlas_option_id"],
        "not_null": ["atlas_id", "meeting_id", "atlas_meeting_id", "atlas_custom_attribute_id", "atlas_option_id"],
        "nice_to_have": ["id", "value", "meeting_id"],
        "uuid_columns": ["atlas_id", "atlas_meeting_id", "atlas_custom_attribute_id", "atlas_option_id"],
        "unique": ["id", "atlas_id"],
    },
    "project_custom_attribute_values*": {
        "required": ["atlas_id", "project_id", "atlas_project_id", "atlas_custom_attribute_id", "atlas_option_id"],
        "not_null": ["atlas_id", "project_id", "atlas_project_id", "atlas_custom_attribute_id", "atlas_option_id"],
        "nice_to_have": ["id", "value"],
        "uuid_columns": ["atlas_id", "atlas_project_id", "atlas_custom_attribute_id", "atlas_option_id"],
        "unique": ["id", "atlas_id"],
    },
    "people_references*": {
        "required": ["id", "atlas_id", "person_id", "atlas_person_id", "atlas_relationship_id", "source", "text",
                     "created_by_atlas_id"],
        "not_null": ["id", "atlas_id", "person_id", "atlas_person_id", "atlas_relationship_id", "source", "text",
                     "created_by_atlas_id"],
        "uuid_columns": ["atlas_id", "atlas_person_id", "atlas_relationship_id", "created_by_atlas_id"],
        "unique": ["id", "atlas_id"],
        "iso_timestamp": ["created_at", "updated_at"],
        "allowed_values": {"source": ["candidate", "other", "we_sourced"]},
    },
    "people_relationships*": {
        "required": ["id", "atlas_id", "person_id", "atlas_person_id", "subordinate_id", "atlas_subordinate_id",
                     "relationship_type", "created_by_atlas_id"],
        "not_null": ["id", "atlas_id", "person_id", "atlas_person_id", "subordinate_id", "atlas_subordinate_id",
                     "relationship_type", "created_by_atlas_id"],
        "nice_to_have": ["company_id", "atlas_company_id"],
        "uuid_columns": ["atlas_id", "atlas_person_id", "atlas_subordinate_id", "created_by_atlas_id",
                         "atlas_company_id"],
        "unique": ["id", "atlas_id"],
        "iso_timestamp": ["created_at", "updated_at"],
        "allowed_values": {"relationship_type": ["direct_manager", "peer", "other"]},
    },
    "people_salaries*": {
        "required": ["atlas_id", "created_at", "updated_at", "created_by_id", "person_id", "atlas_person_id",
                     "currency", "created_by_atlas_id"],
        "not_null": ["id", "atlas_id", "created_at", "updated_at", "created_by_id", "person_id", "atlas_person_id",
                     "created_by_atlas_id", "currency", "tax_method", "expected_salary_type", "source", "type"],
        "nice_to_have": ["id", "relevant_date"],
        "uuid_columns": ["atlas_id", "created_by_atlas_id"],
        "unique": ["id", "atlas_id"],
        "iso_timestamp": ["created_at", "updated_at", "relevant_date"],
        "currency": ["currency"],
        "numeric": ["basic_salary", "bonus_salary", "total_salary", "expected_salary_min", "expected_salary_max"],
        "allowed_values": {"type": ["actual", "expected"],
                           "tax_method": ["gross", "net", "daily_rate", "hourly_rate"],
                           "expected_salary_type": ["basic", "gross", "total"],
                           "source": ["migration", "email", "note", "interview"]},
        "warn_null": {"basic_salary": 0.2,
                      "bonus_salary": 0.1,
                      "total_salary": 0.2,
                      "expected_salary_min": 0.5,
                      "expected_salary_max": 0.5,
                      "country": 0.2,
                      "benefits": 0.2,
                      "notes": 0.2},
    },
    "gdpr_emails*": {
        "required": ["atlas_id", "person_id", "atlas_person_id", "atlas_sender_id", "sent_at"],
        "not_null": ["id", "atlas_id", "person_id", "atlas_person_id", "sender_id", "atlas_sender_id", "sent_at"],
        "nice_to_have": ["id", "sender_id"],
        "uuid_columns": ["atlas_id", "atlas_person_id", "atlas_sender_id"],
        "unique": ["id", "atlas_id"],
        "iso_timestamp": ["sent_at"],
    },
    "person_notes*": {
        "required": ["id", "atlas_id", "created_at", "updated_at", "person_id", "atlas_person_id", "text",
                     "created_by_id", "created_by_atlas_id", "type"],
        "not_null": ["id", "atlas_id", "created_at", "updated_at", "person_id", "atlas_person_id", "text",
                     "created_by_atlas_id", "type"],
        "uuid_columns": ["atlas_id", "atlas_person_id", "created_by_atlas_id"],
        "unique": ["atlas_id"],
        "no_html_columns": ["text"],
        "allowed_values": {"type": ["phone_call", "manual"]},
    },
    "company_notes*": {
        "required": ["id", "atlas_id", "created_at", "updated_at", "company_id", "atlas_company_id", "text",
                     "created_by_id", "created_by_atlas_id", "type"],
        "not_null": ["id", "atlas_id", "created_at", "updated_at", "company_id", "atlas_company_id", "text",
                     "created_by_id", "created_by_atlas_id", "type"],
        "uuid_columns": ["atlas_id", "atlas_company_id", "created_by_atlas_id"],
        "unique": ["id", "atlas_id"],
        "no_html_columns": ["text"],
    },
    "people*": {
        "required": ["first_name", "last_name", "id", "atlas_id", "created_by_id", "created_by_atlas_id",
                     "updated_by_id", "updated_by_atlas_id", "responsiveness", "candidate_status",
                     "location_locality"],
        "nice_to_have": ["location_name", "location_locality", "location_street_address", "location_metro",
                         "location_country", "location_postal_code"],
        "uuid_columns": ["atlas_id", "created_by_atlas_id", "updated_by_atlas_id"],
        "unique": ["id", "atlas_id"],
        "trim": ["first_name", "last_name"],
        "warn_null": {"created_by_id": 0.2,
                      "updated_by_id": 0.2,
                      "location_name": 0.0,
                      "location_locality": 0.5,
                      "location_street_address": 0.5,
                      "location_country": 0.5,
                      "location_postal_code": 0.1},
        "error_null": {"location_locality": 0.2},
        "location_coverage": 0.5,
        "constant": {"responsiveness": "active", "candidate_status": "regular"},
        "constant_across_table": ["agency_id"],
    },
    "project_users*": {
        "required": ["atlas_id", "user_id", "atlas_user_id", "project_id", "atlas_project_id"],
        "not_null": ["id", "atlas_id", "user_id", "atlas_user_id", "project_id", "atlas_project_id"],
        "nice_to_have": ["id"],
        "uuid_columns": ["atlas_id", "atlas_user_id", "atlas_project_id"],
        "unique": ["id", "atlas_id"],
        "iso_timestamp": ["created_at", "updated_at"],
    },
    "company_relationships*": {
        "required": ["atlas_id", "company_id", "atlas_company_id", "subsidiary_id", "atlas_subsidiary_id",
                     "relationship_type", "created_by_atlas_id"],
        "not_null": ["atlas_id", "company_id", "atlas_company_id", "subsidiary_id", "atlas_subsidiary_id",
                     "relationship_type", "created_by_atlas_id"],
        "uuid_columns": ["atlas_id", "atlas_company_id", "atlas_subsidiary_id", "created_by_atlas_id"],
        "unique": ["id", "atlas_id"],
        "iso_timestamp": ["created_at", "updated_at"],
        "allowed_values": {"relationship_type": ["parent", "investment"]},
    },
    "person_identities*": {
        "required": ["atlas_id", "value", "favourite", "active", "type", "identity_type_type", "class_type",
                     "person_id", "atlas_person_id", "source"],
        "not_null": ["atlas_id", "value", "favourite", "active", "type", "identity_type_type", "class_type",
                     "person_id", "atlas_person_id", "source"],
        "nice_to_have": ["id", "inactive_reason"],
        "uuid_columns": ["id", "atlas_id", "created_by_atlas_id", "updated_by_atlas_id"],
        "unique": ["id", "atlas_id", "value"],
        "allowed_values": {"type": ["phone", "email", "linkedin", "github"],
                           "inactive_reason": ["unsubscribed"],
                           "identity_type_type": ["personal", "corporate"],
                           "class_type": ["EmailPersonIdentity", "PhonePersonIdentity", "LinkedinPersonIdentity",
                                          "SocialPersonIdentity"]},
        "boolean_is": {"verified": True},
        "isBoolean": ["favourite", "active", "verified"],
        "constant": {"source": "migration"},
    },
    "companies*": {
        "required": ["atlas_id", "name", "relationship"],
        "not_null": ["id", "atlas_id", "name", "relationship"],
        "nice_to_have": ["location_locality", "location_name", "location_metro", "location_street_address",
                         "location_country", "summary", "created_at", "updated_at", "size",
                         "restriction_relevant_id", "restiction_note", "restriction_expiry_date"],
        "uuid_columns": ["atlas_id", "created_by_atlas_id", "updated_by_atlas_id"],
        "unique": ["id", "atlas_id"],
        "warn_null": {"location_name": 0.5, "location_locality": 0.5},
        "allowed_values": {"relationship": ["none", "target", "client"],
                           "company_size": ["1-10", "11-50", "51-200", "201-500", "501-1000", "1001-5000",
                                            "5001-10000", "10000+"]},
    },
    "company_identities*": {
        "required": ["atlas_id", "company_id", "atlas_company_id", "type", "value"],
        "not_null": ["atlas_id", "company_id", "atlas_company_id", "type", "value"],
        "nice_to_have": ["id"],
        "uuid_columns": ["atlas_id", "atlas_company_id"],
        "unique": ["id", "atlas_id", "value"],
        "allowed_values": {"type": ["website", "linkedin", "facebook", "phone", "crunchbase", "twitter", "x",
                                    "instagram", "youtube", "tiktok", "pinterest"]},
        "isBoolean": ["is_primary"],
        "booleanIsMixed": {"is_primary": True},
        "url": ["value"],
    },
    "experiences*": {
        "required": ["atlas_id", "atlas_person_id", "source", "started_at", "finished_at", "title", "company_name"],
        "not_null": ["id", "atlas_id", "person_id", "atlas_person_id", "source", "started_at", "company_name"],
        "nice_to_have": ["company_id", "atlas_company_id", "description", "title"],
        "uuid_columns": ["atlas_id", "atlas_person_id", "atlas_company_id"],
        "unique": ["id", "atlas_id"],
        "warn_null": {"company_id": 0.9, "title": 0.8},
        "constant": {"source": "migration"},
        "date_ymd_columns": ["started_at", "finished_at"],
        "no_html_columns": ["description"],
    },
    "educations*": {
        "required": ["atlas_id", "person_id", "atlas_person_id"],
        "not_null": ["atlas_id", "person_id", "atlas_person_id"],
        "nice_to_have": ["degree", "field_of_study", "description", "grade", "name"],
        "uuid_columns": ["atlas_id", "atlas_person_id"],
        "unique": ["id", "atlas_id"],
        "constant": {"source": "migration"},
        "date_ymd_columns": ["started_at", "finished_at"],
        "warn_null": {"name": 0.2, "degree": 0.2, "field_of_study": 0.2, "description": 0.75, "grade": 0.75},
    },
    "projects*": {
        "required": ["id", "atlas_id", "job_role", "state", "owner_id", "atlas_owner_id", "job_number"],
        "not_null": ["id", "atlas_id", "job_role", "state"],
        "nice_to_have": ["company_id", "atlas_company_id", "job_description_text", "close_reason", "closed_at",
                         "contract_type", "location_locality", "notes", "expected_fee", "salary_currency"],
        "uuid_columns": ["atlas_id", "atlas_owner_id", "atlas_company_id"],
        "unique": ["id", "atlas_id", "job_number"],
        "currency": ["salary_currency"],
        "warn_null": {"contract_type": 0.5,
                      "location_locality": 0.5,
                      "expected_fee": 0.5,
                      "salary_currency": 0.5,
                      "company_id": 0.8},
        "constant": {"class_type": "project"},
        "allowed_values": {"state": ["active", "closed", "on_hold", "lead", "talent_pool"],
                           "close_reason": ["cancelled", "won", "worked_lost", "lead_lost"],
                           "contract_type": ["full_time", "contract", "non_exec", "part_time"]},
    },
    "project_company_contacts_*": {
        "required": ["project_id", "atlas_project_id", "atlas_company_contact_id"],
        "not_null": ["project_id", "atlas_project_id", "company_contact_id", "atlas_company_contact_id"],
        "nice_to_have": ["company_contact_id"],
    },
    "company_contacts*": {
        "required": ["atlas_id", "atlas_person_id", "company_id", "atlas_company_id", "relationship", "title"],
        "not_null": ["atlas_id", "atlas_person_id", "company_id", "atlas_company_id", "relationship", "title"],
        "nice_to_have": ["id", "person_id"],
        "uuid_columns": ["atlas_id", "atlas_person_id", "atlas_company_id"],
        "unique": ["id", "atlas_id"],
        "allowed_values": {"relationship": ["client", "prospect", "none"]},
    },
    "candidates*": {
        "required": ["atlas_id", "person_id", "atlas_person_id", "project_id", "atlas_project_id", "status",
                     "atlas_owner_id"],
        "not_null": ["atlas_id", "person_id", "atlas_person_id", "project_id", "atlas_project_id", "status",
                     "owner_id", "atlas_owner_id"],
        "nice_to_have": ["rejection_type", "rejection_reason", "rejected_at", "atlas_rejected_by_id"],
        "uuid_columns": ["atlas_id", "atlas_person_id", "atlas_project_id", "atlas_owner_id",
                         "atlas_rejected_by_id"],
        "unique": ["id", "atlas_id"],
        "iso_timestamp": ["rejected_at"],
        "allowed_values": {"status": ["Added", "Internal IV", "Presented", "Client IV", "Offer", "Hired"],
                           "rejection_type": ["by_client", "by_us", "self"],
                           "rejection_reason": ["not_qualified", "above_budget", "accepted_another_offer",
                                                "cultural_fit", "location", "other"]},
    },
    "custom_attributes*": {
        "required": ["atlas_id", "multiple_values", "of", "name", "ai"],
        "not_null": ["id", "atlas_id", "multiple_values", "of", "name", "ai"],
        "nice_to_have": ["id", "type"],
        "uuid_columns": ["atlas_id"],
        "unique": ["id", "atlas_id"],
        "allowed_values": {"type": ["options"], "of": ["company", "person", "interview", "project"]},
        "isBoolean": ["multiple_values", "ai"],
    },
    "custom_attribute_options*": {
        "required": ["atlas_id", "atlas_attribute_id", "value", "position"],
        "not_null": ["id", "atlas_id", "atlas_attribute_id", "value", "position"],
        "nice_to_have": ["id", "attribute_id"],
        "uuid_columns": ["atlas_id", "atlas_attribute_id"],
        "unique": ["id", "atlas_id"],
        "no_html_columns": ["value"],
        "consecutive_attribute_positions": True,
    },
    "meetings*": {
        "required": ["atlas_id", "created_at", "updated_at", "notes", "person_id", "atlas_person_id", "status",
                     "name"],
        "not_null": ["atlas_id", "created_at", "updated_at", "person_id", "atlas_person_id", "status"],
        "nice_to_have": ["id"],
        "uuid_columns": ["atlas_id", "atlas_person_id"],
        "unique": ["id", "atlas_id"],
        "iso_timestamp": ["created_at", "updated_at"],
        "no_html_columns": ["notes"],
        "allowed_values": {"status": ["transcribed", "completed"], "name": ["migrated meeting"]},
    },
    "users*": {
        "required": ["id", "atlas_id", "name", "email", "status"],
        "not_null": ["id", "atlas_id", "name", "email", "status"],
        "uuid_columns": ["atlas_id"],
        "unique": ["id", "atlas_id", "email"],
        "email": ["email"],
        "valid_email": ["email"],
        "allowed_values": {"status": ["active", "disabled"]},
    },
    "fee_types*": {
        "required": ["atlas_id", "created_at", "updated_at", "name", "project_fee_type", "created_by_atlas_id"],
        "not_null": ["id", "atlas_id", "created_at", "updated_at", "created_by_id", "created_by_atlas_id", "name",
                     "project_fee_type"],
        "nice_to_have": ["id"],
        "uuid_columns": ["atlas_id", "created_by_atlas_id"],
        "unique": ["id", "atlas_id", "name"],
        "iso_timestamp": ["created_at", "updated_at"],
        "constant": {"project_fee_type": "fee"},
    },
    "project_fees*": {
        "required": ["atlas_id", "fee_date", "amount", "currency", "project_fee_status", "project_id",
                     "atlas_project_id", "fee_type_id"],
        "not_null": ["atlas_id", "fee_date", "amount", "currency", "project_fee_status", "project_id",
                     "atlas_project_id"],
        "nice_to_have": ["created_by_id", "atlas_created_by_id", "paid_at", "external_id", "invoiced_at",
                         "start_date", "end_date", "payment_currency", "charge_currency", "charge_amount",
                         "payment_type", "category", "person_id", "atlas_person_id", "notes"],
        "uuid_columns": ["atlas_id", "atlas_project_id", "atlas_created_by_id", "atlas_person_id"],
        "unique": ["id", "atlas_id"],
        "iso_timestamp": ["paid_at", "invoiced_at", "start_date", "end_date"],
        "currency": ["currency", "payment_currency", "charge_currency"],
        "numeric": ["amount", "charge_amount"],
        "allowed_values": {"project_fee_status": ["projected", "earned", "invoiced", "paid"],
                           "payment_type": ["daily", "hourly"],
                           "category": ["contract", "placement", ""]},
    },
    "project_fee_splits": {
        "required": ["atlas_id", "share", "fee_earner_id", "atlas_fee_earner_id", "project_id", "atlas_project_id"],
        "not_null": ["id"],
        "nice_to_have": ["id", "created_by_id", "atlas_created_by_id", "fee_type_id", "notes"],
        "uuid_columns": ["atlas_id", "atlas_fee_earner_id", "atlas_project_id", "atlas_created_by_id"],
        "unique": ["id", "atlas_id"],
    },
    "placements": {
        "required": ["atlas_id", "atlas_project_id", "created_at", "atlas_candidate_id"],
        "nice_to_have": ["id", "atlas_project_fee_id", "project_id", "candidate_id"],
        "uuid_columns": ["atlas_id", "atlas_project_id", "atlas_candidate_id", "atlas_project_fee_id"],
        "unique": ["id", "atlas_id"],
        "iso_timestamp": ["created_at"],
    },
    "opportunities*": {
        "required": ["atlas_id", "created_at", "updated_at", "name", "type", "atlas_created_by_id", "stage_id",
                     "owner_id", "atlas_owner_id", "manual_named"],
        "not_null": ["id", "atlas_id", "created_at", "updated_at", "name", "type", "atlas_created_by_id",
                     "stage_id", "owner_id", "atlas_owner_id"],
        "nice_to_have": ["id", "atlas_speculative_person_id", "speculative_person_id", "rejection_reason",
                         "rejected_by_id", "rejected_at", "atlas_rejected_by_id"],
        "uuid_columns": ["atlas_id", "atlas_created_by_id", "atlas_owner_id", "atlas_speculative_person_id",
                         "atlas_rejected_by_id"],
        "unique": ["id", "atlas_id"],
        "iso_timestamp": ["created_at", "updated_at", "rejected_at"],
        "isBoolean": ["manual_named"],
        "allowed_values": {"type": ["regular", "speculative"], "rejection_reason": ["cancelled", "converted"]},
        "constant": {"manual_named": True},
    },
    "target_companies*": {
        "required": ["atlas_id", "created_at", "updated_at", "company_id", "atlas_company_id", "opportunity_id",
                     "atlas_opportunity_id"],
        "not_null": ["id", "atlas_id", "created_at", "updated_at", "company_id", "atlas_company_id",
                     "opportunity_id", "atlas_opportunity_id"],
        "nice_to_have": ["id"],
        "uuid_columns": ["atlas_id", "atlas_company_id", "atlas_opportunity_id"],
        "unique": ["id", "atlas_id"],
        "iso_timestamp": ["created_at", "updated_at"],
    },
    "opportunity_stages*": {
        "required": ["id", "atlas_id", "created_by_id", "atlas_created_by_id", "name", "position", "type"],
        "not_null": ["id", "atlas_id", "created_by_id", "atlas_created_by_id", "name", "position", "type"],
        "nice_to_have": ["created_at", "updated_at"],
        "uuid_columns": ["atlas_id", "atlas_created_by_id"],
        "unique": ["id", "atlas_id", "name", "position"],
        "numeric": ["position"],
        "constant": {"type": "default_stage"},
    },
    "opportunity_people*": {
        "required": ["atlas_id", "created_at", "updated_at", "person_id", "atlas_person_id", "atlas_opportunity_id",
                     "created_by_id", "atlas_created_by_id"],
        "not_null": ["id", "atlas_id", "created_at", "updated_at", "person_id", "atlas_person_id",
                     "atlas_opportunity_id", "created_by_id", "atlas_created_by_id"],
        "nice_to_have": ["id", "opportunity_id"],
        "uuid_columns": ["atlas_id", "atlas_person_id", "atlas_opportunity_id", "atlas_created_by_id"],
        "unique": ["id", "atlas_id"],
        "iso_timestamp": ["created_at", "updated_at"],
    },
}
# Salaries of people go by two names.
CONTRACTS = {k: v for name, rules in CONTRACTS.items()
             for k, v in (((name, rules), ("person_salaries*", rules)) if name == "people_salaries*" else ((name, rules),))}

# Tables that only serve to build others: they have no contract, though their names begin like those that do.
HELPER_TABLES = ["people_to_import", "people_dupes", "companies_to_import"]

# Columns that may never be NULL in any canonical table that has them.
NEVER_NULL_SUFFIX = "atlas_id"


def matches(table: str, pattern: str) -> bool:
    """A table fits a pattern as a glob, by its exact name, or by the name followed by an underscore suffix."""
    base = pattern[:-1] if pattern.endswith("*") else pattern
    return fnmatchcase(table, pattern) or table == base or fnmatchcase(table, f"{base}_*")


def matching_contract(table: str, rules: Mapping[str, Any] | None = None) -> str | None:
    """The first pattern, in order, the table fits; helper tables fit none."""
    if any(table == name or table.startswith(f"{name}_") for name in HELPER_TABLES):
        return None
    return next((p for p in (CONTRACTS if rules is None else rules) if matches(table, p)), None)


def select_tables(names: Iterable[str], prefixes: Iterable[str] = ()) -> list[str]:
    wanted = tuple(prefixes)
    return [n for n in names if not wanted or n.startswith(wanted)]


def load_rules(path: str) -> tuple[dict[str, Any], dict[str, Any]]:
    """(global rules, table rules) from a rules file in YAML."""
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("reading a rules file needs the yaml package; pass the rules as mappings") from missing
    with open(path, encoding="utf-8") as source:
        rules = yaml.safe_load(source)
    if not isinstance(rules, dict) or "tables" not in rules:
        raise ValueError(f"{path}: a rules file has a 'tables' section")
    return rules.get("global", {}), rules["tables"]
