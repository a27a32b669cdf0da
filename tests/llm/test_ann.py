"""Vector search against brute force: recall, exact distances and order."""

import numpy as np
from pyspark.sql import functions as F

from rosterlift.llm import queries
from rosterlift.llm.ann import LearnedPartitions, balanced_partition, nearest

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(ids, x, queries_, k=10):
    out = {}
    for q in queries_:
        d = np.sqrt(((x - x[ids == q][0])**2).sum(1))
        d[ids == q] = np.inf
        order = np.lexsort((ids, d))[:min(k, len(ids) - 1)]
        out[int(q)] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def check(got, ids, x, queries_, least):
    want, hits, total = brute(ids, x, queries_), 0, 0
    assert set(got) == set(want)
    for q, near in got.items():
        assert len(near) == len(want[q])
        assert near == sorted(near, key=lambda r: (r[1], r[0]))
        for i, d in near:
            assert abs(d - np.sqrt(((x[ids == i][0] - x[ids == q][0])**2).sum())) < 1e-12
        hits += len({i for i, _ in near} & {i for i, _ in want[q]})
        total += len(near)
    assert hits >= least * total


def test_whole_table(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    check(answers(queries.op2_learned_partitions(spark, small)), ids, x, ids[ids % 100 == 0], 0.9)


def test_recall_on_clusters_with_a_hot_one(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(40, 16)) * 4
    x = np.concatenate([centers[rng.integers(40, size=4000)] + rng.normal(size=(4000, 16)), np.repeat(centers[:1], 2000, 0)]).astype(np.float32)
    ids = rng.permutation(len(x))
    df = spark.createDataFrame([(int(i), v.tolist(), "s") for i, v in zip(ids, x, strict=True)], SCHEMA)
    p = LearnedPartitions(sample=2048, rows_per_partition=100, group=500)
    check(answers(nearest(df, F.col("vec_id") % 50 == 0, p=p)), ids, x.astype(float), ids[ids % 50 == 0], 0.9)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], ""), (1, [0.0, 0.0], ""), (2, None, ""), (3, [nan, 1.0], ""), (4, [inf, 1.0], ""), (5, [None, 1.0], ""),
            (6, [], ""), (7, [1.0, 2.0, 3.0], ""), (None, [1.0, 1.0], ""), (8, [1.0, 1.0], ""), (8, [1.0, 1.0], ""), (9, [1.0, -1.0], "")]
    got = answers(nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 3 == 0))
    assert got == {0: [(8, 1.0), (9, 1.0)], 9: [(0, 1.0), (8, 2.0)]}


def test_an_id_repeated_more_often_than_k(spark):
    # Id 5 has 12 copies of one vector, id 6 has 30 vectors, all of them nearer to the query than the other ids.
    rows = [(0, [1.0, 1.0], "")] + [(5, [1.0, 1.25], "")] * 12 + [(6, [1.0, 1.5 + i / 64], "") for i in range(30)]
    rows += [(i, [1.0, float(i)], "") for i in range(10, 30)]
    got = answers(nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0))
    assert got == {0: [(5, 0.25), (6, 0.5), *[(i, i - 1.0) for i in range(10, 18)]]}


def test_an_id_in_many_partitions_leaves_no_query_short(spark):
    # Id 1 lies everywhere, so it alone makes every partition look as if it held enough.
    rng = np.random.default_rng(7)
    rows = [(1, v.tolist(), "") for v in rng.normal(size=(1500, 2)) * 10] + [(i, v.tolist(), "") for i, v in enumerate(rng.normal(size=(60, 2)) * 10, 100)]
    p = LearnedPartitions(sample=1024, rows_per_partition=50, recall=0.0, group=100)
    got = answers(nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") >= 100, p=p))
    assert {q: len(near) for q, near in got.items()} == dict.fromkeys(range(100, 160), 10)
    x = {i: np.array([v for j, v, _ in rows if j == i], float).astype(np.float32).astype(float) for i in (1, *range(100, 160))}
    for q, near in got.items():
        for i, d in near:
            if i != 1:
                assert abs(d - np.sqrt(((x[i][0] - x[q][0])**2).sum())) < 1e-12


def test_empty_and_single(spark):
    assert nearest(spark.createDataFrame([], SCHEMA), F.lit(True)).collect() == []
    assert nearest(spark.createDataFrame([(1, [1.0], "")], SCHEMA), F.lit(True)).collect() == []


def test_partitions_are_balanced_and_keep_neighbours_together():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(640, 2)).astype(np.float32)
    d = ((x[:, None] - x[None])**2).sum(2)
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1)[:, :8]
    part = balanced_partition(x, near, 10)
    assert np.bincount(part, minlength=10).max() <= 71
    assert (part[near] == part[:, None]).mean() > 0.6
