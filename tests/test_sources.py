import os

import pytest
from pyspark.sql import functions as F

from rosterlift.session import discard_durables, durable, scratch_root
from rosterlift.sources import (SourceMap, TableReader, common_type, constant_row, file_ranges, is_clustered, literal_relation,
                                overwrite_table, read_range, read_seed, read_shards, reconcile, union_shards)


def test_shards_found_fallback_and_none(spark, tmp_path):
    reader = TableReader(spark, str(tmp_path))
    none = read_shards(reader, "work_{}", "work", "id int")
    assert none.columns == ["id", "source_table"] and none.isEmpty()
    spark.range(2).write.parquet(f"{tmp_path}/work.parquet")
    assert [r.source_table for r in read_shards(TableReader(spark, str(tmp_path)), "work_{}", "work", "id int").collect()] == ["work"] * 2
    spark.range(1).write.parquet(f"{tmp_path}/work_1.parquet")
    spark.range(3).withColumn("more", F.lit("x")).write.parquet(f"{tmp_path}/work_3.parquet")
    got = read_shards(TableReader(spark, str(tmp_path)), "work_{}", "work", "id int")
    assert sorted(r.source_table for r in got.collect()) == ["work_1"] + ["work_3"] * 3
    assert set(got.columns) == {"id", "more", "source_table"}


def test_shards_have_no_upper_number(spark, tmp_path):
    for n in (*range(1, 60), 1000):
        spark.range(1).write.parquet(f"{tmp_path}/work_{n}_data.parquet")
    spark.range(1).write.parquet(f"{tmp_path}/work_x_data.parquet")
    got = read_shards(TableReader(spark, str(tmp_path)), "work_{}_data", "work_data", "id int")
    assert sorted(r.source_table for r in got.collect()) == sorted(f"work_{n}_data" for n in (*range(1, 60), 1000))


def test_shards_of_a_database(spark):
    spark.sql("CREATE DATABASE shards")
    for n in (2, 70):
        spark.range(n).write.saveAsTable(f"shards.work_{n}")
    assert read_shards(TableReader(spark, database="shards"), "work_{}", "work", "id int").count() == 72
    spark.sql("DROP DATABASE shards CASCADE")


def test_source_map_filters_before_renaming(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, None)], "userid int, isdeleted int")
    assert SourceMap("t", {"id": "userid"}, "isdeleted != 1").read(lambda _: df).collect() == [(1,)]


def test_seed_schema(spark, tmp_path):
    path = tmp_path / "user_mapping.csv"
    path.write_text("email,name,id,atlas_id\na@b.c,Ann,7,x-1\n")
    assert read_seed(spark, str(path), "user_mapping").first()[:] == ("a@b.c", "Ann", 7, "x-1")


def test_literals(spark):
    assert literal_relation(spark, ("a", "b"), [(1, "x"), (2, None)]).collect() == [(1, "x"), (2, None)]
    assert constant_row(spark, a=1, b=F.lit("y")).collect() == [(1, "y")]


def test_overwrite_is_a_full_refresh_in_key_order(spark, tmp_path):
    path = str(tmp_path / "out")
    overwrite_table(spark.range(10), path)
    overwrite_table(spark.range(100).orderBy(F.rand(1)), path, ["id"], files=4)
    back = spark.read.parquet(path)
    assert back.count() == 100
    spans = back.groupBy(F.input_file_name().alias("f")).agg(F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("lo").collect()
    assert all(a.hi < b.lo for a, b in zip(spans, spans[1:]))


def test_durable_cuts_lineage_and_uses_the_shared_folder(spark):
    df = durable(spark.range(5).withColumn("r", F.rand()))
    assert df.collect() == df.collect()
    folder = df.inputFiles()[0].removeprefix("file:").replace("//", "").rsplit("/", 1)[0]
    assert folder.startswith(scratch_root(spark).removeprefix("file:").replace("//", ""))
    discard_durables(spark)
    assert not os.path.exists(folder)


@pytest.mark.parametrize(("settings", "root"), [({"spark.checkpoint.dir": "/shared/x", "spark.sql.warehouse.dir": "/w"}, "/shared/x"),
                                                ({"spark.sql.warehouse.dir": "/w/"}, "/w/_scratch")])
def test_shared_folder(settings, root):
    from types import SimpleNamespace
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
    assert scratch_root(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getConf=lambda: conf))) == root


def test_missing_table_raises(spark, tmp_path):
    with pytest.raises(Exception):
        TableReader(spark, str(tmp_path))("nothing")


def test_a_cluster_has_to_name_its_shared_folder():
    from types import SimpleNamespace as namespace
    settings = {"spark.master": "spark://host:7077"}
    spark = namespace(conf=namespace(get=lambda key, default=None: default), sparkContext=namespace(getConf=lambda: settings))
    with pytest.raises(ValueError, match="checkpoint"):
        scratch_root(spark)


def test_a_failed_refresh_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    overwrite_table(spark.range(10), path)
    dies = spark.range(0, 4000, 1, 4).select(F.when(F.col("id") == 3990, F.raise_error(F.lit("dead")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="dead"):
        overwrite_table(dies, path)
    assert any(f.startswith("_t.parquet-staging-") for f in os.listdir(tmp_path))
    reader = TableReader(spark, str(tmp_path))
    assert reader("t").count() == 10 and reader.names() == ["t"]
    overwrite_table(TableReader(spark, str(tmp_path))("t").where("id < 4"), path)  # from its own rows
    assert spark.read.parquet(path).count() == 4 and os.listdir(tmp_path) == ["t.parquet"]


def test_a_swap_that_was_cut_short(spark, tmp_path):
    path = tmp_path / "t.parquet"
    overwrite_table(spark.range(10), str(path))
    os.rename(path, tmp_path / "_t.parquet-previous-1")  # the second rename never came
    os.makedirs(tmp_path / "_t.parquet-previous-0")  # and this one was never whole
    assert TableReader(spark, str(tmp_path))("t").count() == 10
    overwrite_table(spark.range(3), str(path))
    assert TableReader(spark, str(tmp_path))("t").count() == 3 and os.listdir(tmp_path) == ["t.parquet"]


def test_footers_tell_which_files_a_range_needs(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(5000).select("id", F.format_string("k%05d", "id").alias("k"), F.when(F.col("id") < 0, 1).alias("none")).orderBy(F.rand(2))
    overwrite_table(rows, path, ["id"], files=8)
    ranges = file_ranges(spark, path, "id")
    assert len(ranges) == 8 and is_clustered(ranges) and sum(r.rows for r in ranges) == 5000
    assert (min(r.least for r in ranges), max(r.greatest for r in ranges)) == (0, 4999)
    assert is_clustered(file_ranges(spark, path, "k")) and all(r.least is None for r in file_ranges(spark, path, "none"))
    found = read_range(spark, path, "id", 100, 120)
    assert len(found.inputFiles()) == 1 and found.count() == 21
    assert read_range(spark, path, "k", "k04990", "z").count() == 10 and read_range(spark, path, "id", 9000, 9001).count() == 0
    overwrite_table(rows.repartition(4), path)
    assert not is_clustered(file_ranges(spark, path, "id")) and read_range(spark, path, "id", 100, 120).count() == 21


def test_shards_of_several_types(spark):
    shards = {"a": spark.createDataFrame([(1, 1, "x")], "id int, n int, only string"), "b": spark.createDataFrame([(2, "two")], "id long, n string"),
              "c": spark.createDataFrame([(3, 2.5)], "id long, n double")}
    common, widened = reconcile(shards)
    assert {c: k.simpleString() for c, k in common.items()} == {"id": "bigint", "n": "string", "only": "string"}
    assert widened == [("id", "a", "int", "bigint"), ("n", "a", "int", "string"), ("n", "c", "double", "string")]
    assert sorted(tuple(r) for r in union_shards(shards).collect()) == [(1, "1", "x", "a"), (2, "two", None, "b"), (3, "2.5", None, "c")]


@pytest.mark.parametrize(("kinds", "common"), [
    (["int", "smallint"], "int"), (["int", "decimal(5,2)"], "decimal(12,2)"), (["bigint", "decimal(38,30)"], "double"), (["float", "int"], "double"),
    (["date", "timestamp"], "timestamp"), (["boolean", "int"], "string"), (["void", "date"], "date"), (["void"], "string"), (["date"], "date")])
def test_common_type(spark, kinds, common):
    types = [spark.sql(f"SELECT CAST(NULL AS {k}) AS c").schema["c"].dataType for k in kinds]
    assert common_type(types).simpleString() == common
