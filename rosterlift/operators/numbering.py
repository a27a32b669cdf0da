"""Dense 1..n numbering that no single task has to carry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .slices import SLICES, key_of, may_be_split, split_points, with_slice


def number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position", slices: int = SLICES) -> DataFrame:
    """Number the rows of each key 1..n by the columns ``order``, ascending with nulls last, which are unique within a key.

    A key's rows are numbered within slices of the order, so a large key spreads over many tasks, and the counts of the slices
    before are added. Only keys with a split point have several, at most as many as there are points: their counts are one value
    of bounded size. Nothing is stored or run when the plan is built; the rows are read twice more for their keys and order
    alone. With no keys the whole relation is numbered.
    """
    points = split_points(df, keys, order, slices)
    large = with_slice(df.where(may_be_split(points, keys)), points, keys, order, slices).withColumn("_key", key_of(keys))
    sizes = large.groupBy("_key", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # The first slice of a key is 0, any other one is of that key alone.
    before = sizes.select("_slice", F.sum("_n").over(earlier).alias("_before")).where("_slice > 0")
    held = F.map_from_entries(F.collect_list(F.struct("_slice", F.coalesce("_before", F.lit(0)))))
    every = F.transform(F.sequence(F.lit(0), F.lit(slices - 1)), lambda s: F.coalesce(F.try_element_at("held", s), F.lit(0).cast("long")))
    counts = before.agg(held.alias("held")).select(every.alias("counts")).scalar()
    local = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*[F.col(c).asc_nulls_last() for c in order]))
    rows = with_slice(df, points, keys, order, slices).withColumn("_local", local)
    position = F.col("_local") + F.when(F.col("_slice") > 0, F.get(counts, F.col("_slice"))).otherwise(0)
    return rows.select(*df.columns, position.cast("int").alias(name))
