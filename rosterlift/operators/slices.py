"""Slices of an order, so that no task has to hold a whole group.

Split points are the order values of a fixed number of rows, those with the smallest hashes: a uniform sample that is the
same in every run and every pass over the rows. They are an aggregate of the plan, found when it runs; nothing is stored.
A key without a split point is one slice, and its rows are told by one look at the points' hashes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICES = 256  # a power of two; a key with a third of all rows takes about a third of them


def key_of(keys: Sequence[str]) -> Column:
    """The keys as one value in which nulls equal nulls."""
    return F.struct(*keys) if keys else F.lit(0)


def order_of(order: Sequence[str | Column]) -> Column:
    """The order as one value, ascending with nulls last."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    return F.struct(*[x.alias(f"{kind}{i}") for i, c in enumerate(columns) for kind, x in (("empty", c.isNull()), ("value", c))])


def split_points(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], slices: int = SLICES) -> Column:
    """``at``: up to ``slices - 1`` places (key, order) in ascending order, and ``hashes`` of their keys, as a subquery of one value.

    Its size does not depend on that of the table. Values that grow without bound, such as texts, are best given by a part that
    sorts like them.
    """
    seen = df.select(F.struct(key_of(keys).alias("key"), order_of(order).alias("order")).alias("at"))
    sample = seen.orderBy(F.xxhash64("at"), "at").limit(slices - 1)
    points = sample.agg(F.sort_array(F.collect_list("at")).alias("at"))
    hashes = F.array_distinct(F.transform("at", lambda p: F.xxhash64(p["key"])))
    return points.select(F.struct("at", hashes.alias("hashes")).alias("points")).scalar()


def may_be_split(points: Column, keys: Sequence[str]) -> Column:
    """Whether the row's key has a split point; another key does with the probability of a hash collision."""
    return F.array_contains(points["hashes"], F.xxhash64(key_of(keys)))


def with_slice(df: DataFrame, points: Column, keys: Sequence[str], order: Sequence[str | Column], slices: int = SLICES) -> DataFrame:
    """Add ``_slice``, the number of the row's last split point if that belongs to its key, else 0. Slices rise with the order within a
    key, and one other than 0 is of one key alone."""
    at, here = points["at"], F.struct(key_of(keys).alias("key"), order_of(order).alias("order"))
    rows = df.withColumn("_large", may_be_split(points, keys)).withColumn("_slice", F.lit(0))
    for step in (slices >> k for k in range(1, slices.bit_length())):
        further = F.col("_large") & (F.get(at, F.col("_slice") + step - 1) <= here)
        rows = rows.withColumn("_slice", F.col("_slice") + F.when(further, step).otherwise(0))
    own = (F.col("_slice") > 0) & (F.get(at, F.col("_slice") - 1)["key"] == key_of(keys))
    return rows.withColumn("_slice", F.when(own, F.col("_slice")).otherwise(0)).drop("_large")


def placed(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], slices: int = SLICES) -> DataFrame:
    """Every row with ``_key``, its keys as one value, ``_order`` and ``_slice``, which rises with the order within a key."""
    rows = with_slice(df, split_points(df, keys, order, slices), keys, order, slices)
    return rows.withColumns({"_key": key_of(keys), "_order": order_of(order)})
