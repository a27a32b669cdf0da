"""Every builder's table has the columns its contract requires, and no NULL where it allows none."""

import pytest

import __spark_entry__ as entry
from rosterlift.quality import CONTRACTS, evaluate, matching_contract

FOLDER = "/root/testdata/sf0.001"
# The table that each query builds.
BUILT = {
    "e01_users": "users_x", "e04_people": "people_x", "e04_people_two_lists": "people_x", "e06_person_identities": "person_identities_x",
    "e08_companies": "companies_x", "e09_company_identities": "company_identities_x", "e10_company_contacts": "company_contacts_x",
    "e11_company_relationships": "company_relationships_x", "e12_experiences": "experiences_x", "e13_educations": "educations_x",
    "e14_projects": "projects_x", "e15_project_company_contacts": "project_company_contacts_x", "e16_project_users": "project_users_x",
    "e17_candidates": "candidates_x", "e17_candidates_history": "candidates_x", "e17_candidates_stages": "candidates_x",
    "e18_person_notes": "person_notes_x", "e18_form_notes": "person_notes_x", "e18_email_notes": "person_notes_x",
    "e18_linked_notes": "person_notes_x", "e19_company_notes": "company_notes_x", "e20_meetings": "meetings_x", "e20_channel_meetings": "meetings_x",
    "e21_salaries_text": "person_salaries_x", "e21_salaries_bonus": "person_salaries_x", "e21_salary_rates": "person_salaries_x",
    "e23_attribute_options": "custom_attribute_options_x", "e26_project_fees": "project_fees_x", "e27_fee_splits": "project_fee_splits",
    "e28_placements": "placements", "e33_opportunities": "opportunities_x", "e33_opportunity_people": "opportunity_people_x",
    "e33_target_companies": "target_companies_x"}
# NULLs that the sources themselves hold, or that the models write: a profile has no scope, and orphans are kept on purpose.
NULLS = {"e06_person_identities": ("identity_type_type",), "e17_candidates_history": ("atlas_person_id", "atlas_project_id"),
         "e19_company_notes": ("created_by_id",), "e21_salaries_text": ("created_at", "updated_at")}


@pytest.mark.parametrize("name", BUILT)
def test_required_columns_and_nulls(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    rules = CONTRACTS[matching_contract(BUILT[name])]
    missing = sorted({*rules.get("required", []), *rules.get("not_null", [])} - {*df.columns})
    assert missing == []
    wanted = {"required": rules.get("required", []), "not_null": [c for c in rules.get("not_null", []) if c not in NULLS.get(name, ())]}
    bad = [(r.column_name, r.rule, r.n_bad) for r in evaluate(df, BUILT[name], wanted, {}).collect() if not r.passed]
    assert bad == []


def test_salary_and_helper_tables():
    assert CONTRACTS[matching_contract("person_salaries_bh")] is CONTRACTS["people_salaries*"]
    assert [matching_contract(t) for t in ("people_to_import_bh", "people_dupes_bh", "companies_to_import")] == [None] * 3
    assert matching_contract("people_bh") == "people*"


def test_entries_that_are_easily_lost():
    assert "meeting_id" in CONTRACTS["meeting_custom_attribute_values*"]["nice_to_have"]
    assert "id" in CONTRACTS["target_companies*"]["not_null"]
