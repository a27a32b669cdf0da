"""Connected components of a link table, by Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.joins import one_per_key
from ._store import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node, component`` for every node of ``links`` (u, v): the smallest node it is connected to.

    Alternates two steps on the links (large star, small star): each node's neighbours are tied to the smallest
    of them, first the larger neighbours, then the smaller ones, until every link leads to a root. No node's
    neighbours are gathered: the minimum is a partial aggregate, and a hot node is split in the join.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    edges, before = _kept(edges, scratch, f"{name}-0")
    step = 0
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = one_per_key(both, [F.col("u").alias("n")], F.min("v").alias("m"))
        large = both.join(low, F.col("u") == F.col("n")).where("v > u")
        large = large.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        low = one_per_key(large, [F.col("u").alias("n")], F.min("v").alias("m"))
        small = large.join(low, F.col("u") == F.col("n"))
        small = small.select("u", F.col("m").alias("v")).union(small.where("v <> m").select(F.col("v").alias("u"),
                                                                                      F.col("m").alias("v")))
        step += 1
        edges, now = _kept(small.distinct(), scratch, f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
        if now == before:  # every link leads to a root
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def joined(where: DataFrame | None, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node, component`` after more links: components so far are joined by the links between them, which are few.

    ``where`` is what this function has returned before, or None. A component keeps being named by its smallest node.
    """
    if where is None:
        return scratch.keep(components(links, scratch, name), f"{name}-where", few=True)
    at = where.select(F.col("node").alias("at"), F.col("component").alias("c"))
    for side in ("u", "v"):
        links = links.join(at, F.col(side) == F.col("at"), "left").withColumn(side, F.coalesce("c", side)).drop("at", "c")
    merged = components(links, scratch, name)
    to = merged.select(F.col("node").alias("at"), F.col("component").alias("to"))
    moved = where.join(to, F.col("component") == F.col("at"), "left").select("node", F.coalesce("to", "component").alias("component"))
    alone = merged.join(where.select(F.col("node").alias("at")), F.col("node") == F.col("at"), "left_anti")
    return scratch.keep(moved.union(alone), f"{name}-where", few=True)


def _kept(edges: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, dict]:
    """The stored links, and their number with an order-free digest, taken while they are written."""
    seen = Observation()
    edges = edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 31)).alias("digest"))
    return scratch.keep(edges, name, few=True), seen.get
