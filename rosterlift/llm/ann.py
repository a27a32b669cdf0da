"""Nearest neighbours by learned partitions of a neighbour graph.

A bounded sample gives a neighbour graph, which is cut into partitions of equal size with few neighbours apart. A small
classifier learns from a vector which partitions hold its neighbours. Every row goes to its most probable partition; a
query visits its most probable ones, as many as the sample's own neighbours needed, and ranks what it finds there by
exact distances.

Partitions may be uneven, and a third of all rows may lie in one. Rows and queries of a partition are dealt over groups of
bounded size, and only pairs of such groups meet in a task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import Scratch


@dataclass(frozen=True)
class LearnedPartitions:
    sample: int = 8192  # rows the partitions and the classifier are learnt from, at most
    rows_per_partition: int = 256  # aimed at; there are at most sample / 32 partitions
    neighbours: int = 10  # of the graph
    recall: float = 0.97  # of the sample's own neighbours, by which the number of visits is set
    group: int = 4096  # rows, and queries, that meet in one task, at most


@dataclass
class Router:
    weights: np.ndarray
    bias: np.ndarray
    center: np.ndarray
    scale: float
    visits: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.center) / self.scale) @ self.weights + self.bias


def _nearest(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each row, block by block."""
    norm = (x * x).sum(1)
    out = np.empty((len(x), k), np.int64)
    for i in range(0, len(x), 1024):
        d = norm[None, :] - 2 * (x[i:i + 1024] @ x.T)
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        out[i:i + 1024] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def _halved(x: np.ndarray, rows: np.ndarray, parts: int, first: int, out: np.ndarray) -> None:
    """Cut along the widest direction, in proportion to the number of partitions on each side."""
    if parts == 1:
        out[rows] = first
        return
    y = x[rows] - x[rows].mean(0)
    way = np.linalg.eigh(y.T @ y)[1][:, -1]
    order = rows[np.argsort(y @ way, kind="stable")]
    left = parts // 2
    at = len(rows) * left // parts
    _halved(x, order[:at], left, first, out)
    _halved(x, order[at:], parts - left, first + left, out)


def balanced_partition(x: np.ndarray, near: np.ndarray, parts: int, sweeps: int = 8) -> np.ndarray:
    """Partitions of about equal size: halving first, then moves to the partition that holds most of a row's neighbours."""
    out = np.zeros(len(x), np.int64)
    _halved(x, np.arange(len(x)), parts, 0, out)
    size = np.bincount(out, minlength=parts)
    most = math.ceil(len(x) / parts * 1.1)
    both = [[] for _ in range(len(x))]
    for i, row in enumerate(near.tolist()):
        for j in row:
            both[i].append(j)
            both[j].append(i)
    both = [np.array(b) for b in both]
    for _ in range(sweeps):
        moved = 0
        for i in range(len(x)):
            held = np.bincount(out[both[i]], minlength=parts)
            held[size >= most] = np.minimum(held[size >= most], held[out[i]])
            to = int(held.argmax())
            if held[to] > held[out[i]]:
                size[out[i]] -= 1
                size[to] += 1
                out[i] = to
                moved += 1
        if moved < len(x) // 200:
            break
    return out


def fit(x: np.ndarray, rows: int, p: LearnedPartitions) -> Router:
    """The router learnt from the sample ``x`` of a table of ``rows`` vectors."""
    x = x.astype(np.float64)
    n, dims = x.shape
    center = x.mean(0)
    scale = float(np.sqrt(((x - center)**2).sum(1).mean())) or 1.0
    parts = max(1, min(math.ceil(rows / p.rows_per_partition), n // 32))
    if parts == 1:
        return Router(np.zeros((dims, 1)), np.zeros(1), center, scale, 1)
    y = ((x - center) / scale).astype(np.float32)
    k = min(p.neighbours, n - 1)
    near = _nearest(y, k)
    part = balanced_partition(y, near, parts)
    # What the classifier should say: the share of a row's neighbours, and itself, in each partition.
    target = np.zeros((n, parts), np.float32)
    np.add.at(target, (np.repeat(np.arange(n), k), part[near].ravel()), np.float32(1 / (k + 1)))
    target[np.arange(n), part] += np.float32(1 / (k + 1))
    means = np.stack([y[part == c].mean(0) if (part == c).any() else y.mean(0) for c in range(parts)])
    w, b = (4 * means.T).astype(np.float32), (-2 * (means**2).sum(1)).astype(np.float32)
    state = [np.zeros_like(v) for v in (w, w, b, b)]
    for step in range(1, 121):  # Adam on all rows
        z = y @ w + b
        z = np.exp(z - z.max(1, keepdims=True))
        off = (z / z.sum(1, keepdims=True) - target) / n
        for at, (v, slope) in enumerate(((w, y.T @ off + 1e-6 * w), (b, off.sum(0)))):
            m, s = state[2 * at], state[2 * at + 1]
            m += 0.1 * (slope - m)
            s += 0.01 * (slope**2 - s)
            v -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-9)
    scores = y @ w + b
    home = scores.argmax(1)
    rank = np.argsort(np.argsort(-scores, axis=1), axis=1)
    needed = np.sort(rank[np.repeat(np.arange(n), k), home[near].ravel()])
    visits = int(needed[min(len(needed) - 1, math.ceil(p.recall * len(needed)))]) + 1
    return Router(w.astype(np.float64), b.astype(np.float64), center, scale, visits)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _packed(batches):
    """Vectors as bytes of doubles; what is null, zero or not finite is left out."""
    for batch in batches:
        column = batch.column(1)
        sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
        ends = np.cumsum(sizes)
        ids, size, vectors = [], [], []
        for i, at, n in zip(batch.column(0).to_pylist(), (ends - sizes).tolist(), sizes.tolist(), strict=True):
            v = flat[at:at + n]
            if i is not None and n and np.isfinite(v).all() and v.any():
                ids.append(i)
                size.append(n)
                vectors.append(v.astype("<f8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(size, pa.int32()), pa.array(vectors, pa.binary())],
                                         ["vec_id", "size", "vector"])


def _route(router, visits: int, sizes: np.ndarray | None = None, least: int = 0):
    """The most probable partitions of each vector: ``visits`` of them, and more until they hold ``least`` rows."""
    def run(batches):
        own = router.value
        for batch in batches:
            if batch.num_rows:
                scores = own.scores(_matrix(batch.column(1)))
                best = np.argsort(-scores, axis=1, kind="stable")
                taken = np.broadcast_to(np.arange(best.shape[1]) < visits, best.shape)
                if sizes is not None:
                    before = np.cumsum(sizes[best], axis=1) - sizes[best]
                    taken = taken | (before < least)
                row, at = np.nonzero(taken)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(best[row, at].astype(np.int32))],
                    ["vec_id", "vector", "part"])
    return run


def _rank(k: int):
    """The k nearest rows of each query of a group; of rows that repeat an id the nearest."""
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = [[], [], []]
        if queries.num_rows and rows.num_rows:
            ids = rows.column("vec_id").to_numpy()
            x, asked = _matrix(rows.column("vector")), _matrix(queries.column("vector"))
            norm = (x * x).sum(1)
            by_id = np.argsort(ids, kind="stable")
            own, starts = np.unique(ids[by_id], return_index=True)
            for q, v in zip(queries.column("vec_id").to_pylist(), asked, strict=True):
                rough = norm - 2 * (x @ v)
                rough[ids == q] = np.inf
                left = int((own != q).sum())
                if not left:
                    continue
                # Rounding must not decide: all that is about as near as the k-th id is measured exactly.
                slack = 1e-9 * (norm.max() + v @ v)
                least = np.minimum.reduceat(rough[by_id], starts)
                reach = np.partition(least, min(k, left) - 1)[min(k, left) - 1] + slack
                pick = np.flatnonzero(rough <= reach)
                d = np.sqrt(((x[pick] - v)**2).sum(1))
                order = np.lexsort((d, ids[pick]))
                order = order[np.unique(ids[pick][order], return_index=True)[1]]
                order = order[np.lexsort((ids[pick][order], d[order]))][:k]
                out[0] += [q] * len(order)
                out[1] += ids[pick][order].tolist()
                out[2] += d[order].tolist()
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                        ["query_id", "vec_id", "score"])
    return run


def _dealt(df: DataFrame, own: str, other: str) -> tuple[Column, Column]:
    """A row's group of its own kind, and all groups of the other kind that it has to meet."""
    mine = F.pmod(F.xxhash64("vec_id", "vector"), F.col(own)).cast("int")  # an id may have many vectors
    return mine, F.explode(F.sequence(F.lit(0), F.col(other) - 1))


def nearest(table: DataFrame, is_query: Column, k: int = 10, p: LearnedPartitions = LearnedPartitions(), id_col: str = "vec_id",
            vector_col: str = "embedding", scratch: Scratch | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows found for every row that ``is_query`` (a condition on vec_id).

    Euclidean distances of the original vectors in double precision, nearest first, ties to the smaller id. Rows with a
    null id, and vectors that are null, empty, zero or hold null or non-finite components, take no part; nor do vectors of
    another length than most have (of equally frequent lengths the longer counts). Rows that repeat an id: as candidates
    the nearest counts, as queries the greatest vector. A query finds fewer rows only if there are fewer. Other columns do not matter.
    """
    spark = table.sparkSession
    scratch = scratch or Scratch(spark)
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.mapInArrow(_packed, "vec_id long, size int, vector binary")
    # Equal rows are one row from here on.
    rows = scratch.keep(rows.groupBy("vec_id", "size", "vector").agg(F.count(F.lit(1)).alias("times")), "vectors")
    sizes = rows.groupBy("size").agg(F.sum("times").alias("n"), F.count(F.lit(1)).alias("rows")).orderBy(F.desc("n"), F.desc("size")).first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.col("size") == sizes["size"]).select("vec_id", "vector")
    sample = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id", "vector").limit(p.sample).select("vector").toArrow()
    router = fit(_matrix(sample.column(0).combine_chunks()), sizes["rows"], p)
    shared = spark.sparkContext.broadcast(router)
    kind = "vec_id long, vector binary, part int"
    homes = scratch.keep(rows.mapInArrow(_route(shared, 1), kind), "homes")
    asked = rows.where(is_query).groupBy("vec_id").agg(F.max("vector").alias("vector"))
    # A number for each partition, of which there are at most sample / 32.
    held = np.zeros(len(router.bias), np.int64)
    # An id whose vectors lie in several partitions counts in one of them: what is visited holds at least so many ids.
    for part, n in homes.groupBy("vec_id").agg(F.min("part").alias("part")).groupBy("part").count().collect():
        held[part] = n
    asked = scratch.keep(asked.mapInArrow(_route(shared, router.visits, held, k + 1), kind), "asked")

    def groups(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / p.group).cast("int").alias(name))
    counts = F.broadcast(groups(homes, "row_groups").join(groups(asked, "query_groups"), "part"))
    homes, asked = homes.join(counts, "part"), asked.join(counts, "part")
    mine, others = _dealt(homes, "row_groups", "query_groups")
    homes = homes.select("part", mine.alias("row_group"), others.alias("query_group"), "vec_id", "vector")
    mine, others = _dealt(asked, "query_groups", "row_groups")
    asked = asked.select("part", mine.alias("query_group"), others.alias("row_group"), "vec_id", "vector")
    key = ["part", "row_group", "query_group"]
    found = asked.groupBy(*key).cogroup(homes.groupBy(*key)).applyInArrow(_rank(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
