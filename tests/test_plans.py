"""What the physical plans must and must not contain."""

import re

import pytest

from workload import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


PRODUCTS = ("BroadcastNestedLoopJoin", "CartesianProduct")


@pytest.mark.parametrize("name", ["j11_match_any_key", "j12_guarded_match", "j20_not_in", "j05_three_way_lookup", "e04_people",
                                  "e04_people_two_lists", "e06_person_identities", "e12_experiences", "e14_projects", "e17_candidates",
                                  "e17_candidates_history", "e20_channel_meetings", "e24_attribute_values", "c04_field_diff"])
def test_large_inputs_join_on_keys(spark, no_broadcast, name):
    text = plan(spark, name)
    assert not any(p in text for p in PRODUCTS)
    assert "BroadcastHashJoin" not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_plans(spark, name):
    text = plan(spark, name)
    assert not any(p in text for p in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups"))


def test_unpivot_reads_its_table_once(spark):
    assert plan(spark, "u03_unpivot").count("FileScan") == 1
    assert plan(spark, "e21_salary_rates").count("Location") == 2  # the wide table and the people


def test_one_pass_rules_read_their_table_once(spark):
    assert plan(spark, "q03_not_null").count("FileScan") == 1
    assert plan(spark, "q04_unique").count("FileScan") == 1


def test_history_needs_no_join(spark):
    assert "Join" not in plan(spark, "h02_last_non_rejected")


@pytest.mark.parametrize("name", ["w01_keep_first", "w02_priority", "w11_two_stage", "e10_company_contacts", "q31_samples"])
def test_top_rows_are_pruned_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert "WindowGroupLimit" in text and "Partial" in text


@pytest.mark.parametrize("name", ["a01_first_last", "a08_duplicate_count", "c05_multiset_diff", "k02_orphans", "q04_unique"])
def test_aggregates_start_before_the_shuffle(spark, name):
    assert "partial_" in plan(spark, name)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "s01_scan")
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in text
    assert "l_extendedprice" not in text.split("ReadSchema")[1]


def test_candidates_with_a_history_are_exchanged_by_project_once(spark, no_broadcast):
    text = plan(spark, "e17_candidates")
    assert not re.search(r"hashpartitioning\(project_id#\d+L?, person_id#", text)
    assert "atlas_person_id" not in text.split("hashpartitioning(project_id#")[-1]


def test_numbering_joins_nothing(spark):
    assert "Join" not in plan(spark, "w14_numbered_links")


def test_contacts_of_projects_are_not_sorted_for_one_per_person(spark):
    assert "Window" not in plan(spark, "e10_contacts_from_projects")


def test_placements_exchange_uuids_as_bytes(spark, no_broadcast):
    before_the_join = plan(spark, "e28_placements").split("hashpartitioning(project_id#", 1)[-1]
    assert before_the_join.count("unhex(replace(") >= 3
