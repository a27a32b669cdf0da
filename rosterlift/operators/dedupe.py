"""Keep-first de-duplication and its variants.

``row_number() = 1`` lets Spark prune to one row per key before the shuffle (WindowGroupLimit), so a key that holds
a third of the table reaches its task as one row per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Key = Column | str


def keep_first(df: DataFrame, keys: Sequence[Key], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``. End ``order`` with a unique column to make the choice repeatable."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def one_per_id(df: DataFrame, row_id: str = "id", newest: str = "modified_at") -> DataFrame:
    """One row per id, the newest; among those of one time the same one in every run. An export that repeats a row would otherwise
    multiply all that refers to it."""
    return keep_first(df, [row_id], [F.col(newest).desc_nulls_last(), F.xxhash64(*df.columns).asc()])


def keep_top(df: DataFrame, keys: Sequence[Key], order: Sequence[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def priority(value: Key, ranked: Sequence[str]) -> Column:
    """Position of a code in a list, last for codes off it; an ordering key for ``keep_first``."""
    pairs = [F.lit(x) for i, code in enumerate(ranked) for x in (code, i)]
    c = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), F.lit(len(ranked)))


def filled_first(value: Key) -> Column:
    """Ordering key that puts rows with a non-blank value first."""
    c = F.col(value) if isinstance(value, str) else value
    return (c.isNull() | (c == "")).asc()


def occurring_once(df: DataFrame, value: str, owner: str) -> DataFrame:
    """Values found on exactly one row, with their owner."""
    return (df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"), F.min(owner).alias(owner))
            .where("_n = 1").drop("_n"))


def flag_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], row_id: Sequence[str],
               name: str) -> DataFrame:
    """Every row, with a flag on the first of its key.

    The first rows are found by pruning and joined back on the unique ``row_id``: no task sees a whole group.
    """
    winners = keep_first(df, keys, order).select(*row_id, F.lit(True).alias("_first"))
    return df.join(winners, list(row_id), "left").withColumn(name, F.coalesce("_first", F.lit(False))).drop("_first")


def on_first_holder_only(df: DataFrame, value: str, order: Sequence[Column], row_id: Sequence[str]) -> DataFrame:
    """A value that must be unique stays on its first holder and becomes NULL on the others."""
    holders = keep_first(df.where(F.col(value).isNotNull()), [value], order)
    kept = holders.select(*row_id, F.col(value).alias("_kept"))
    return df.join(kept, list(row_id), "left").withColumn(value, F.col("_kept")).drop("_kept")


def two_stage(df: DataFrame, first: tuple[Sequence[Key], Sequence[Column]],
              second: tuple[Sequence[Key], Sequence[Column]]) -> DataFrame:
    """Keep-first within the narrow key, then within the wide one."""
    return keep_first(keep_first(df, *first), *second)


def column_maxima(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key by the maximum of each column on its own; values may come from different rows."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in rest])
