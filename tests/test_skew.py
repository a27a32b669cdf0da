"""A key that holds a third of the rows: joins split it, windows and aggregates meet it reduced."""

import pytest
from pyspark.sql import functions as F

from rosterlift.operators import dedupe, joins

SETTINGS = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k", "spark.sql.shuffle.partitions": "64"}
N = 400_000


@pytest.fixture
def hot(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark.range(N).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20_000).alias("k"), F.xxhash64("id").alias("p"))
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    """Row count and final plan of a query that needs every column."""
    total = df.select(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns) % 10))
    count = total.first()[0]
    frame = df.select(F.sum(F.xxhash64(*df.columns) % 10))
    frame.collect()
    return count, frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_key_mapping_splits_the_hot_key(spark, hot):
    ref = spark.range(20_000).select("id", F.concat(F.lit("a"), "id").alias("atlas_id"))
    count, plan = executed(joins.fk_map(hot, "k", ref, "atlas_id", "a"))
    assert count == N and "skew=true" in plan


def test_exclusion_splits_the_hot_key(spark, hot):
    count, plan = executed(joins.exclude(hot, "k", spark.range(0, 20_000, 2), "id"))
    assert count == hot.where("k % 2 = 1").count() and "skew=true" in plan


def test_lookup_by_text_splits_the_hot_key(spark, hot):
    ref = spark.range(20_000).select("id", F.col("id").cast("string").alias("name"))
    count, plan = executed(joins.lookup_by_text(hot, "k", ref, "name", {"found": "id"}))
    assert count == N and "skew=true" in plan


def test_matching_splits_the_hot_key(hot):
    right = hot.select(F.col("id").alias("rid"), "k")
    count, plan = executed(joins.match_any_key(hot, "id", right, "rid", [("k", "k", "k")]))
    assert count == N and "skew=true" in plan


def test_keep_first_shuffles_one_row_per_key_and_partition(spark, hot):
    kept = dedupe.keep_first(hot, ["k"], [F.col("p").asc()])
    assert kept.count() == hot.select("k").distinct().count()
