import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rosterlift.operators import chains, dedupe, history, joins, numbering, reshape, slices


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_keep_first_is_idempotent_and_breaks_ties(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, None, "z"), (None, 1, "n")], "k int, t int, id string")
    order = [F.col("t").desc_nulls_last(), F.col("id").asc()]
    once = dedupe.keep_first(df, ["k"], order)
    assert sorted(rows(once), key=str) == [(1, 5, "a"), (None, 1, "n")]
    assert sorted(rows(dedupe.keep_first(once, ["k"], order)), key=str) == sorted(rows(once), key=str)


def test_flag_first_and_first_holder_keep_every_row(spark):
    df = spark.createDataFrame([(1, "a", 3), (2, "a", 1), (3, None, 2), (4, None, 1)], "id int, v string, t int")
    assert rows(dedupe.flag_first(df, ["v"], [F.col("t").asc()], ["id"], "f").select("id", "f"), "id") == [
        (1, False), (2, True), (3, False), (4, True)]
    assert rows(dedupe.on_first_holder_only(df, "v", [F.col("t").asc()], ["id"]).select("id", "v"), "id") == [
        (1, None), (2, "a"), (3, None), (4, None)]


@pytest.mark.parametrize("keys", [["k"], []])
def test_numbering_equals_brute_force_with_a_hot_key(spark, keys):
    rng = random.Random(3)
    data = [("hot" if i % 3 == 0 else rng.choice(["a", "b", None]), i) for i in rng.sample(range(100_000), 6000)]
    df = spark.createDataFrame(data, "k string, v int").repartition(7)
    got = {(r.k, r.v): r.position for r in numbering.number_within(df, keys, ["v"]).collect()}
    seen: dict = {}
    for k, v in sorted(data, key=lambda x: x[1]):
        group = k if keys else ""
        seen[group] = seen.get(group, 0) + 1
        assert got[(k, v)] == seen[group]
    assert len(got) == len(data)


def test_numbering_spreads_a_hot_key(spark):
    df = spark.range(40_000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    ranged = df.repartitionByRange(4, "k", "v").select(F.spark_partition_id().alias("p")).groupBy("p").count()
    assert ranged.agg(F.max("count")).first()[0] < 20_000


def test_fk_map_never_grows(spark):
    df = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, fk int")
    ref = spark.createDataFrame([(10, "x")], "id int, atlas_id string")
    assert rows(joins.fk_map(df, "fk", ref, "atlas_id", "a", default="m").select("id", "a"), "id") == [(1, "x"), (2, "m"), (3, "m")]
    assert rows(joins.fk_map(df, "fk", ref, "atlas_id", "a").select("id", "a"), "id") == [(1, "x"), (2, None), (3, None)]
    assert rows(joins.fk_map(df, "fk", ref, "atlas_id", "a", policy="exclude").select("id", "a")) == [(1, "x")]


def test_exclude_keeps_rows_without_key_and_ignores_null_refs(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    ref = spark.createDataFrame([(1,), (None,)], "id int")
    assert rows(joins.exclude(df, "id", ref), F.col("id").asc_nulls_first()) == [(None,), (2,)]


def test_match_any_key_equals_brute_force(spark):
    rng = random.Random(5)
    def side(n, tag):
        return [(f"{tag}{i:03}", rng.choice(["", None, "e1", "e2", f"e{i}"]), rng.choice([None, "p1", f"p{i % 9}"])) for i in range(n)]
    left, right = side(60, "l"), side(40, "r")
    a, b = (spark.createDataFrame(s, "id string, e string, p string") for s in (left, right))
    got = dict(rows(joins.match_any_key(a, "id", b, "id", [("e", "e", "e"), ("p", "p", "p")])))
    want = {}
    for i, e, p in left:
        hits = [j for j, f, q in right if (e and e == f) or (p and p == q)]
        if hits:
            want[i] = min(hits)
    assert got == want


def test_match_any_key_with_a_key_shared_by_all(spark):
    # 30,000 x 30,000 rows share one key: pairing them up would mean 900 million rows
    left = spark.range(30_000).select(F.col("id"), F.lit("+").alias("p"))
    right = spark.range(30_000).select((F.col("id") + 5).alias("id"), F.lit("+").alias("p"))
    got = joins.match_any_key(left, "id", right, "id", [("p", "p", "p")]).agg(
        F.count(F.lit(1)), F.min("match_id"), F.max("match_id")).first()
    assert tuple(got) == (30_000, 5, 5)


def test_guarded_match(spark):
    left = spark.createDataFrame([(1, 7, "x"), (2, None, "x"), (3, 99, "x"), (4, None, None)], "id int, own int, ext string")
    right = spark.createDataFrame([(7, "y"), (8, "x"), (9, "x")], "rid int, rext string")
    assert rows(joins.match_id_or_external(left, "id", "own", "ext", right, "rid", "rext"), "id") == [(1, 7), (2, 8)]


def test_lookup_chain_takes_first_key_that_knows_it(spark):
    df = spark.createDataFrame([("1",), ("bob",), ("zed",), (None,)], "o string")
    ref = spark.createDataFrame([(1, "bob", "u1"), (2, "1", "u2")], "id int, name string, atlas_id string")
    got = dict(rows(joins.lookup_chain(df, "o", ref, ["id", "name"], "atlas_id", "u", F.lit("m"))))
    assert got == {"1": "u1", "bob": "u1", "zed": "m", None: "m"}


def test_lookup_by_text_does_not_fan_out(spark):
    df = spark.createDataFrame([(1, " ACME "), (2, ""), (3, None)], "id int, n string")
    ref = spark.createDataFrame([(5, "acme", "a5"), (4, "Acme ", "a4"), (6, "", "a6")], "cid int, name string, atlas_id string")
    got = joins.lookup_by_text(df, "n", ref, "name", {"company_id": "cid", "atlas_company_id": "atlas_id"})
    assert rows(got.select("id", "company_id", "atlas_company_id"), "id") == [(1, 4, "a4"), (2, None, None), (3, None, None)]


def test_nearest_in_time_equals_brute_force(spark):
    rng = random.Random(11)
    start = datetime(2024, 1, 1)
    def moment():
        return start + timedelta(seconds=rng.choice([0, 5, 86399, 86400, 86401, rng.randrange(900_000)]))
    left = [(i, rng.choice(["hot", "a", "b", "empty", None]), moment() if rng.random() > 0.05 else None) for i in range(300)]
    right = [(i, rng.choice(["hot", "hot", "a", "b"]), moment()) for i in range(400)]
    a = spark.createDataFrame(left, "id int, g string, t timestamp")
    b = spark.createDataFrame(right, "rid int, g string, t timestamp")
    got = dict(rows(joins.nearest_in_time(a, "g", "t", b, "t", "rid", "near").select("id", "near")))
    for i, g, t in left:
        hits = [(abs((t - u).total_seconds()), -j) for j, h, u in right if h == g] if t else []
        assert got[i] == (-min(hits)[1] if hits else None), i
    assert len(got) == len(left)


def test_explode_list_has_no_cap(spark):
    df = spark.createDataFrame([(1, "a;b,, c"), (2, ",".join(f"x{i}" for i in range(40))), (3, ""), (4, None)], "id int, v string")
    out = reshape.explode_list(df, "v", "item")
    assert out.where("id = 1").count() == 3 and out.where("id = 2").count() == 40 and out.where("id > 2").count() == 0


def test_ordered_text(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 3, None), (2, 1, "z")], "k int, o int, t string")
    assert rows(reshape.ordered_text(df, ["k"], ["o"], F.col("t"), "|", "out"), "k") == [(1, "a|b"), (2, "z")]


def test_effective_status_equals_brute_force(spark):
    rng = random.Random(2)
    events = [(rng.randrange(40), rng.choice(["in", "out", "no"]), rng.choice([1, 2, 3, None]), i) for i in range(500)]
    df = spark.createDataFrame(events, "p int, s string, t int, e int")
    got = {r.p: (r.latest_status, r.effective_status) for r in history.effective_status(df, ["p"], "s", "t", "e", ["no"]).collect()}
    for p in {e[0] for e in events}:
        line = sorted((e for e in events if e[0] == p), key=lambda e: (e[2] is not None, e[2] or 0, e[3]))
        latest = line[-1][1]
        standing = [e[1] for e in line if e[1] != "no"]
        assert got[p] == (latest, latest if latest != "no" else (standing[-1] if standing else "Added"))


def test_a_constant_relation_has_one_row(spark):
    df = spark.range(3)
    assert joins.with_constant(df, spark.createDataFrame([("x", None)], "a string, b int")).collect() == [(i, "x", None) for i in range(3)]
    for rows in ([("x", 1), ("y", 2)], []):
        with pytest.raises(Exception, match="has to have one row"):
            joins.with_constant(df, spark.createDataFrame(rows, "a string, b int")).collect()


def ends_of(links):
    """The end of each chain by walking it, in plain Python."""
    step = {}
    for a, b in links:
        if a is not None and b is not None and a != b:
            step[a] = min(b, step.get(a, b))
    out = {}
    for a in step:
        path, at = [a], step[a]
        while at in step and at not in path:
            path.append(at)
            at = step[at]
        end = min(path[path.index(at):]) if at in path else at
        if end != a:
            out[a] = (end, at in path)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_survivors_follow_chains_and_cycles(spark, seed):
    rng = random.Random(seed)
    links = [(i, i + 1) for i in range(100, 137)] + [(200 + i, 200 + (i + 1) % 7) for i in range(7)] + [(300, 203), (301, 300)]
    links += [(1, 2), (2, 1), (3, 3), (None, 4), (5, None), (6, 9), (6, 8), (6, 8), (8, 10)] + [(1000 + i, 100) for i in range(400)]
    links += [(rng.randrange(2000, 2060), rng.randrange(2000, 2060)) for _ in range(50)]
    df = spark.createDataFrame(links, "contact_id int, candidate_id int")
    got = {r.contact_id: (r.candidate_id, r.in_cycle) for r in chains.survivors(df).collect()}
    assert got == ends_of(links)
    assert chains.survivors(df.where("false")).count() == 0


def test_one_per_id_takes_the_newest_and_no_row_multiplies(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, 7, "b"), (2, None, "c")], "id int, modified_at int, v string")
    assert rows(dedupe.one_per_id(df), "id") == [(1, 7, "b"), (2, None, "c")]


def test_numbering_builds_a_plan_and_nothing_else(spark, monkeypatch):
    from rosterlift import session
    monkeypatch.setattr(session, "scratch_root", lambda _: 1 / 0)
    df = spark.range(10).selectExpr("id", "IF(id % 3 = 0, NULL, id) AS v", "raise_error('ran') AS boom")
    assert numbering.number_within(df, [], ["v", "id"]).columns == ["id", "v", "boom", "position"]


def test_numbering_puts_nulls_last_and_handles_no_rows(spark):
    df = spark.createDataFrame([(1, None, 4), (1, "b", 1), (None, "a", 2), (None, None, 3), (1, "a", 5)], "k int, v string, i int")
    got = {r.i: r.position for r in numbering.number_within(df, ["k"], ["v", "i"]).collect()}
    assert got == {5: 1, 1: 2, 4: 3, 2: 1, 3: 2}
    assert numbering.number_within(df.where("false"), ["k"], ["v"]).count() == 0


def test_slices_split_a_hot_key(spark):
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, -1, id) AS k", "id * 7919 % 30011 AS v").repartition(5)
    found = slices.placed(df, ["k"], ["v"])
    sizes = [r["count"] for r in found.where("k = -1").groupBy("_slice").count().collect()]
    assert sum(sizes) == 10_000 and max(sizes) < 1200
    edges = found.where("k = -1").groupBy("_slice").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("_slice").collect()
    assert all(a.hi < b.lo for a, b in zip(edges, edges[1:]))


def test_ordered_text_with_a_hot_key_equals_plain_sorting(spark):
    rng = random.Random(4)
    data = [("hot" if i % 3 == 0 else f"k{i % 700}", rng.choice([None, *range(200)]), None if i % 11 == 0 else f"{rng.randrange(50)}" * rng.randrange(1, 40))
            for i in range(9000)]
    df = spark.createDataFrame(data, "k string, o int, t string").repartition(6)
    want = {}
    for k, o, t in sorted((x for x in data if x[2] is not None), key=lambda x: (x[1] is not None, x[1] or 0, x[2])):
        want.setdefault(k, []).append(t)
    got = {r.k: r.out for r in reshape.ordered_text(df, ["k"], ["o"], F.col("t"), "|", "out").collect()}
    assert got == {k: "|".join(v) for k, v in want.items()}
    by = [F.col("o").isNotNull(), F.col("o"), F.substring("t", 1, 32)]
    largest = slices.placed(df, ["k"], by).groupBy("_key", "_slice").count().agg(F.max("count")).first()[0]
    assert largest < 400  # the hot key has 3,000 rows


def test_prior_status_with_a_hot_key_equals_plain_search(spark):
    rng = random.Random(6)
    data = [("hot" if i % 3 == 0 else f"k{rng.randrange(40)}", rng.choice("RAHO"), rng.choice([None, *range(300)]), i) for i in range(4000)]
    want = {}
    for key in {d[0] for d in data}:
        mine = [d for d in data if d[0] == key and d[2] is not None]
        last = max(d[2] for d in mine)
        before = [(d[2], d[3], d[1]) for d in mine if d[1] != "R" and d[2] < last]
        if before:
            want[key] = max(before)[2]
    df = spark.createDataFrame(data, "k string, s string, t int, e int").repartition(5)
    found = history.prior_status(df, ["k"], "s", "t", "e", F.col("s") != "R")
    assert {r.k: r.s for r in found.collect()} == want
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()


def test_rounds_of_chains_pass_nothing_through_the_driver(spark, monkeypatch):
    plans, durable = [], chains.durable

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return durable(df)
    monkeypatch.setattr(chains, "durable", seen)
    df = spark.createDataFrame([(i, i + 1) for i in range(8)], "contact_id long, candidate_id long")
    assert {r.candidate_id for r in chains.survivors(df).collect()} == {8}
    assert len(plans) > 3 and not any("Broadcast" in p for p in plans)
