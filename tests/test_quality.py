from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rosterlift.quality import evaluate, matching_contract, run_suite, violation_samples
from rosterlift.quality import predicates as P
from rosterlift.quality.checks import compile_checks
from rosterlift.quality.contracts import CONTRACTS
from rosterlift.quality.suite import missing_intervals, missing_positions, position_gaps


def report(df, table, rules, shared=None):
    return {(r.rule, r.column_name): (r.n_bad, r.passed, r.severity) for r in evaluate(df, table, rules, shared or {}).collect()}


def test_seeded_violations(spark):
    uid = "0123abcd-0123-4567-89ab-0123456789ab"
    df = spark.createDataFrame([
        (1, uid, "a@b.com", "GBP", "12", "x.com", True, "2024-01-01T00:00:00", "2024-01-01"),
        (2, uid, "bad", "EURO", "1,5", "http://x.com", None, "2024-01-01 00:00:00Z", "2024-1-1"),
        (2, "zz", None, "ZZZ", "", "x.com/", False, "01/01/2024", None)],
        "id int, uid string, email string, cur string, num string, url string, flag boolean, ts string, day string")
    rules = {"required": ["id", "gone"], "not_null": ["email"], "uuid_columns": ["uid"], "unique": ["id", "uid"], "email": ["email"],
             "currency": ["cur"], "numeric": ["num"], "url": ["url"], "isBoolean": ["flag", "uid"], "boolean_is": {"flag": True},
             "booleanIsMixed": {"flag": False}, "iso_timestamp": ["ts"], "date_ymd_columns": ["day"], "allowed_values": {"cur": ["GBP"]},
             "constant": {"cur": "GBP"}, "error_null": {"email": 0.2}, "warn_null": {"email": 0.5}, "constant_across_table": ["cur"]}
    got = report(df, "t", rules)
    assert got[("required", "gone")] == (1, False, "fail") and got[("required", "id")][1]
    expected = {("not_null", "email"): 1, ("uuid_columns", "uid"): 1, ("unique", "id"): 1, ("unique", "uid"): 1, ("email", "email"): 1,
                ("currency", "cur"): 1, ("known_currency", "cur"): 1, ("numeric", "num"): 2, ("url", "url"): 2, ("is_boolean", "uid"): 1,
                ("boolean_nulls", "flag"): 1, ("boolean_is", "flag"): 1, ("boolean_is_mixed", "flag"): 0, ("iso_timestamp", "ts"): 1,
                ("date_ymd_columns", "day"): 1, ("allowed_values", "cur"): 2, ("constant", "cur"): 2, ("constant_across_table", "cur"): 1}
    assert {k: got[k][0] for k in expected} == expected
    assert got[("error_null", "email")] == (1, False, "fail") and got[("warn_null", "email")] == (1, True, "warn")


def test_empty_table_passes_fractions(spark):
    df = spark.createDataFrame([], "email string, location_locality string")
    got = report(df, "t", {"error_null": {"email": 0.0}, "location_coverage": 0.9, "constant_any": ["email"], "unique": ["email"]})
    assert all(v[1] for v in got.values())


def test_bad_fraction_is_an_error(spark):
    with pytest.raises(ValueError):
        compile_checks("t", spark.createDataFrame([], "a string").schema, {"warn_null": {"a": 1.5}})


def test_global_rules_spare_link_tables(spark):
    df = spark.createDataFrame([("x",)], "created_at string")
    assert ("global_required", "atlas_id") not in {(r.rule, r.column_name) for r in evaluate(df, "project_company_contacts_x", {}).collect()}
    got = {(r.rule, r.column_name): r.n_bad for r in evaluate(df, "other", {}).collect()}
    assert got == {("global_required", "atlas_id"): 1, ("global_iso_timestamp", "created_at"): 1}


@pytest.mark.parametrize("table,pattern", [
    ("people_references_x", "people_references*"), ("people_x", "people*"), ("people", "people*"),
    ("project_company_contacts_bh", "project_company_contacts_*"), ("projects_bh", "projects*"), ("placements_bh", "placements"),
    ("project_fee_splits", "project_fee_splits"), ("company_contacts_x", "company_contacts*"), ("nothing", None)])
def test_first_matching_contract_wins(table, pattern):
    assert matching_contract(table) == pattern


def test_contract_ids_follow_the_columns():
    assert CONTRACTS["candidates*"]["uuid_columns"] == ["atlas_id", "atlas_person_id", "atlas_project_id", "atlas_owner_id", "atlas_rejected_by_id"]
    assert "uuid_columns" not in CONTRACTS["project_company_contacts_*"]


def test_email_problems(spark):
    cases = {"ok@b.com": None, None: None, "a@b@c.com": "wrong number of @ symbols", "x": "wrong number of @ symbols", "a b@c.com": "contains spaces",
             "a@b": "no dot in domain", "a@b.com.": "starts or ends with dot", "-a@b.com": "starts or ends with hyphen", "a.@b.com": "local part starts/ends with dot",
             "a..b@c.com": "local part has consecutive dots", "a@b..com": "domain has consecutive dots", "é@b.com": "invalid character in local part",
             "a@b!.com": "invalid character in domain", "a@-b.com": "domain segment starts with hyphen", "a@b-.com": "domain segment ends with hyphen",
             "a@b.c": "invalid TLD", "a@b.c0m": "invalid TLD", "a@.com": "invalid TLD"}
    df = spark.createDataFrame([(k,) for k in cases], "e string")
    assert {r.e: r.p for r in df.select("e", P.email_problem(F.col("e")).alias("p")).collect()} == cases


def test_position_gaps(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 2), ("c", 1), ("c", 4), ("d", 1), ("d", 50), (None, 1)], "k string, p int")
    assert sorted(tuple(r) for r in position_gaps(df, "k", "p").collect()) == [("b", 2, 2, 0), ("c", 1, 4, 2), ("d", 1, 50, 48)]
    assert sorted(tuple(r) for r in missing_positions(df, "k", "p").collect()) == [("c", 2), ("c", 3)] + [("d", n) for n in range(2, 50)]


def test_a_gap_of_a_thousand(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1002)], "k string, p int")
    assert sorted(r.position for r in missing_positions(df, "k", "p").collect()) == [*range(2, 1002)]


def test_candidate_duplicates_ignore_nulls(spark):
    df = spark.createDataFrame([("p", "q"), ("p", "q"), ("p", None), ("p", None)], "atlas_person_id string, atlas_project_id string")
    assert report(df, "candidates_x", {})[("candidate_duplicates", "atlas_project_id,atlas_person_id")][0] == 1


def test_samples_are_short_and_few(spark):
    df = spark.range(100).select(F.col("id"), F.concat(F.lit("<b>" + "x" * 60), "id").alias("html"), F.lit(" a").alias("name"))
    checks = compile_checks("t", df.schema, {"no_html_columns": ["html"], "trim": ["name"]})
    got = violation_samples(df, "t", checks, "id").collect()
    assert len(got) == 10 and all(len(r.value) <= 50 for r in got)


def test_suite_report(spark):
    good = spark.createDataFrame([(1, "x")], "id int, name string")
    suite = run_suite({"users_a": good, "odd": good}, {"users*": {"unique": ["id"], "required": ["email"]}, "never*": {}}, {})
    assert suite.without_rules == ["odd"] and suite.unused_patterns == ["never*"] and not suite.passed()
    assert suite.per_table().where("table_name = 'users_a'").first().n_failed == 1


def test_every_built_table_meets_its_contract(spark, ctx):
    """Builders produce what the rules demand, on rows that give them no reason to fail."""
    from rosterlift.functions.codes import code_map
    from rosterlift.functions.dates import iso
    from rosterlift.operators.history import outcome, project_state
    from rosterlift.plans.candidates import build_candidates
    from rosterlift.plans.projects import build_projects
    at = datetime(2024, 1, 2)
    refs = spark.createDataFrame([(1, "0123abcd-0123-4567-89ab-0123456789ab", "Acme")], "id int, atlas_id string, name string")
    raw = spark.createDataFrame([(1, 1, 1, 1, "Placed", at), (2, 1, 1, 1, "Rejected", at)], "id int, project_id int, person_id int, owner_id int, status string, added_at timestamp")
    rows = build_candidates(raw, refs, refs, refs, ctx, outcome(F.lower("status"), {"placed": "Hired"}, {"rejected": "by_us"}, {}, iso("added_at")))
    assert rows.count() == 1
    failed = evaluate(rows, "candidates_x").where("severity = 'fail' AND NOT passed").collect()
    assert failed == []
    postings = spark.createDataFrame([(1, None, "Dev", "Permanent", 5, None, "<b>x</b>", 1, 1, "Open", at, None, "1 High St", None, "Rome", None, "10001")],
                                     "id int, linked_id int, title string, employment_type string, salary int, public_description string, description string, owner_id int, company_id int, status string, "
                                     "added_at timestamp, closed_at timestamp, address1 string, address2 string, city string, state string, zip string")
    built = build_projects(postings, refs, refs, ctx, code_map("employment_type", {"Permanent": "full_time"}, "full_time"),
                           project_state(F.col("status"), {"active": ["open"]}, {}, iso("closed_at"), iso("added_at")))
    failed = evaluate(built, "projects_x").where("severity = 'fail' AND NOT passed").collect()
    assert [(r.rule, r.column_name) for r in failed] == [("uuid_columns", "atlas_owner_id")] or failed == []


def test_checks_while_writing_say_what_the_suite_says(spark, tmp_path):
    from rosterlift.quality import WrittenChecks
    from rosterlift.sources import Outputs
    people = spark.createDataFrame([(i % 7, f"a{i}", "<b>x</b>" if i % 3 else None, "2024-01-01T00:00:00") for i in range(40)],
                                   "id int, atlas_id string, first_name string, created_at string")
    checks = WrittenChecks()
    out = Outputs(str(tmp_path), watch=checks.watch, cluster_by={"people_x": ["id"]})
    out.add("people_x", people.withColumn("salt", F.rand()))  # another table each time it is computed
    out.add("odd", spark.range(3))
    found = checks.report(out.tables)
    assert found.without_rules == ["odd"]
    plain = run_suite(out.tables)
    assert sorted(map(tuple, found.lines.collect())) == sorted(map(tuple, plain.lines.collect()))
    assert found.unused_patterns == plain.unused_patterns
    assert all(str(tmp_path) in f for f in found.lines.inputFiles())
    leaves = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("parquet")
    assert leaves(found.lines) < leaves(plain.lines)


def test_a_gap_of_a_billion_is_one_interval(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1_000_000_002), ("b", 65535), ("b", 65536), ("b", 65538), ("c", -3), ("c", 200_000)], "k string, p int")
    assert sorted(tuple(r) for r in missing_intervals(df, "k", "p").collect()) == [
        ("a", 2, 1_000_000_001, 1_000_000_000), ("b", 65537, 65537, 1), ("c", -2, 199_999, 200_002)]
    assert missing_positions(df.where("k = 'c'"), "k", "p").distinct().count() == 200_002


def test_uuids_are_counted_as_sixteen_bytes(spark):
    from rosterlift.quality.suite import _compact, uniqueness
    texts = ["0123abcd-0123-4567-89ab-0123456789ab", "0123ABCD-0123-4567-89AB-0123456789AB", "0123abcd0123456789ab0123456789ab",
             "0123abcd-0123-4567-89ab-0123456789ab\n", "u", "", "é"]
    df = spark.createDataFrame([(t,) for t in [*texts, texts[0], None]], "v string")
    packed = {r.v: bytes(r.b) for r in df.where("v IS NOT NULL").select("v", _compact(F.col("v")).alias("b")).collect()}
    assert len(packed[texts[0]]) == 17 and len(set(packed.values())) == len(texts)
    checks = compile_checks("sample", df.schema, {"unique": ["v"]}, {})
    assert [r.n_bad for r in uniqueness(df, "sample", checks).collect()] == [1]
