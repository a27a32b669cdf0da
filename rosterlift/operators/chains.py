"""Chains of merges: who survives when a survivor was itself merged into someone else."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import durable, forget
from .joins import one_per_key


def survivors(links: DataFrame, duplicate: str = "contact_id", survivor: str = "candidate_id") -> DataFrame:
    """``duplicate, survivor, in_cycle``: the end of each duplicate's chain of links, one row per duplicate.

    Of several links of one duplicate the smallest survivor counts; links without either end, or to the row itself, count
    for nothing. Rows that lead into a cycle go to the smallest id of the cycle, which is then no duplicate; ``in_cycle``
    marks them.

    Every row looks twice as far in each round (pointer jumping), so a chain of n links takes about log2(n) joins on the map of
    duplicates. The looked-up side has one row per duplicate, so a survivor that a third of all rows lead to is split like any hot
    key. Rounds are stored and run when this is called; their joins are merged, as the map, which is small when stored and grows with the
    table, would else pass through the driver in every round.
    """
    mapped = links.where(F.col(duplicate).isNotNull() & F.col(survivor).isNotNull() & (F.col(duplicate) != F.col(survivor)))
    state = one_per_key(mapped, [F.col(duplicate).alias("id")], F.min(survivor).alias("next"))
    state = state.withColumns({"least": F.col("next"), "open": F.lit(True)})
    reach, before, stored = 1, None, durable(state)
    while True:
        seen = Observation()
        ahead = stored.select(F.col("id").alias("_id"), F.col("next").alias("_next"), F.col("least").alias("_least")).hint("merge")
        state = stored.join(ahead, F.col("next") == F.col("_id"), "left").select(
            "id", F.coalesce("_next", "next").alias("next"), F.least("least", "_least").alias("least"), F.col("_id").isNotNull().alias("open"))
        stored, last = durable(state.observe(seen, F.count_if("open").alias("n"))), stored
        forget(last)
        reach, left = 2 * reach, seen.get["n"]
        # Open rows look at a duplicate. When no more rows close, all others lead into cycles; as soon as they look further than there
        # are such rows, what they look at lies on its cycle and has seen all of it.
        if left == 0 or (left == before and reach >= left):
            break
        before = left
    on_cycle = stored.where("open").select(F.col("id").alias("_id"), F.col("least").alias("_least")).hint("merge")
    ends = stored.join(on_cycle, F.col("next") == F.col("_id"), "left")
    return ends.select(F.col("id").alias(duplicate), F.coalesce("_least", "next").alias(survivor),
                       F.col("open").alias("in_cycle")).where(F.col(duplicate) != F.col(survivor))
