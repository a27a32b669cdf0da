import pytest

from rosterlift import diff


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame([(1, "a ", 1), (2, "b", None), (3, "c", 3), (4, "d", 4), (4, "d", 5)], "id int, s string, n int")
    right = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "x", 3), (9, "z", 9)], "id int, s string, n int")
    return left, right


def test_a_table_equals_itself(sides):
    left, _ = sides
    unique = left.where("id < 4")
    assert diff.schema_diff(unique, unique).isEmpty() and diff.key_diff(unique, unique, "id").isEmpty()
    assert diff.field_diff(unique, unique, "id").isEmpty() and diff.multiset_diff(left, left).isEmpty()


def test_seeded_changes(sides):
    left, right = sides
    assert sorted(tuple(r) for r in diff.key_diff(left, right, "id").collect()) == [(4, "only_left", 2, 0), (9, "only_right", 0, 1)]
    assert sorted(tuple(r) for r in diff.field_diff(left, right, "id").collect()) == [("n", 1, 33.33), ("s", 1, 33.33)]
    row = diff.diff_summary(left, right, "id").first()
    assert (row.row_count_difference, row.n_only_left, row.n_only_right, row.n_common, row.n_rows_different, row.n_columns_different) == (1, 1, 1, 3, 2, 2)
    assert sorted((r.column_name, r.key, r.left_value, r.right_value) for r in diff.field_samples(left, right, "id").collect()) == [
        ("n", 2, None, "2"), ("s", 3, "c", "x")]


def test_repeated_keys_are_reported_not_multiplied(spark):
    left = spark.createDataFrame([(None, "a")] * 400 + [(1, "b")], "id int, s string")
    got = {r.key: (r.difference, r.n_left, r.n_right) for r in diff.key_diff(left, left, "id").collect()}
    assert got == {None: ("repeated", 400, 400)}


def test_every_row_of_a_repeated_key_is_compared(spark):
    left = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (2, "x", 1), (2, "x", 1), (3, "p", 0), (3, "q", 0)], "id int, s string, n int")
    right = spark.createDataFrame([(1, "z", 1), (1, "b", 1), (2, "x", 1), (3, "q", 0), (3, "p", 0)], "id int, s string, n int")
    assert sorted(tuple(r) for r in diff.field_diff(left, right, "id").collect()) == [("n", 1, 33.33), ("s", 2, 66.67)]
    row = diff.diff_summary(left, right, "id").first()
    assert (row.n_common, row.n_rows_different, row.n_columns_different) == (3, 2, 2)
    assert sorted((r.key, r.left_value, r.right_value) for r in diff.field_samples(left, right, "id", None).collect() if r.column_name == "s") == [
        (1, "a", "z"), (2, "x", None)]


def test_schema_diff_and_key_choice(spark):
    left = spark.createDataFrame([], "company_id int, a string, b int")
    right = spark.createDataFrame([], "company_id int, a int, c int")
    assert [(r.column_name, r.difference) for r in diff.schema_diff(left, right).collect()] == [("a", "type"), ("b", "only_left"), ("c", "only_right")]
    assert diff.likely_key(left, right) == "company_id"
    assert diff.likely_key(left.drop("company_id"), right) is None


def test_nearly_equal_tables_are_compared_by_digests(spark):
    left = spark.range(3000).selectExpr("id % 2900 AS id", "CAST(id * 7 AS STRING) AS s", "IF(id % 5 = 0, NULL, id) AS n")
    same = left.orderBy(diff.F.rand(1))
    assert all(side.isEmpty() for side in diff.differing_rows(left, same, "id"))
    plan = diff.differing_rows(left, same, "id", levels=1)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and plan.count("Aggregate") == 1  # all that is brought together is a row for each bucket
    other = left.withColumn("s", diff.F.when(diff.F.col("id") == 50, "odd").otherwise(diff.F.col("s"))).where("id <> 60")
    a, b = diff.differing_rows(left, other, "id")
    assert {r.id for r in a.collect()} == {50, 60} and a.where("id = 50").count() == 2  # ids 0 to 99 stand there twice
    assert sorted(map(tuple, diff.field_samples(a, b, "id").collect())) == sorted(map(tuple, diff.field_samples(left, other, "id").collect()))
    assert sorted(map(tuple, diff.key_diff(a, b, "id").where("key = 60").collect())) == [(60, "only_left", 2, 0)]
