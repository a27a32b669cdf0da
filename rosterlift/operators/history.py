"""What a status history says about each candidacy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedupe import keep_first, priority
from .joins import one_per_key


def latest_status(df: DataFrame, keys: Sequence[str], status: str, ts: str, event_id: str) -> DataFrame:
    """The newest status per key. Events without a time lose; equal times go to the larger event id."""
    when = F.struct(ts, event_id)
    return one_per_key(df, [F.col(k) for k in keys], F.max_by(status, when).alias("latest_status"), F.max(ts).alias("latest_at"))


def prior_status(df: DataFrame, keys: Sequence[str], status: str, ts: str, event_id: str, keep: Column) -> DataFrame:
    """Per key the newest status that ``keep`` holds for, among those earlier than the key's latest time.

    Moments first, so the history is read and exchanged once. Of a key's moments the two newest that hold such a status and the two
    newest that do not are enough to decide; all others are pruned before the shuffle, so no task sorts a whole history.
    """
    moments = df.where(F.col(ts).isNotNull()).groupBy(*keys, ts).agg(
        F.max_by(F.when(keep, F.col(status)), F.when(keep, F.col(event_id))).alias("_status"), F.max(F.when(keep, 1)).alias("_kept"))
    newest = Window.partitionBy(*keys, "_kept").orderBy(F.col(ts).desc())
    two = moments.withColumn("_turn", F.row_number().over(newest)).where("_turn <= 2")
    kept = F.collect_list(F.when(F.col("_kept") == 1, F.struct(F.col(ts).alias("ts"), F.col("_status").alias("s"))))
    state = one_per_key(two, [F.col(k) for k in keys], F.max(ts).alias("_latest"), kept.alias("_two"))
    before = F.array_max(F.filter("_two", lambda m: m["ts"] < F.col("_latest")))
    return state.withColumn("_last", before).where("_last IS NOT NULL").select(*keys, F.col("_last.s").alias(status))


def effective_status(df: DataFrame, keys: Sequence[str], status: str, ts: str, event_id: str,
                     rejected: Sequence[str], default: str = "Added") -> DataFrame:
    """Latest status, and the one that counts: for a rejected candidacy the last status before that was not a rejection.

    One aggregate over the history, pre-aggregated before the shuffle; no self join.
    """
    when = F.struct(ts, event_id)
    refused = F.col(status).isin(*rejected)
    grouped = one_per_key(
        df, [F.col(k) for k in keys],
        F.max_by(status, when).alias("latest_status"),
        F.max(ts).alias("latest_at"),
        F.max_by(F.when(~refused, F.col(status)), F.when(~refused, when)).alias("_standing"))
    counted = F.when(F.col("latest_status").isin(*rejected), F.coalesce("_standing", F.lit(default)))
    return grouped.withColumn("effective_status", counted.otherwise(F.col("latest_status"))).drop("_standing")


def outcome(code: Column, status: Mapping[str, str], rejection_type: Mapping[str, str],
            rejection_reason: Mapping[str, str], at: Column, default_status: str | None = "Added",
            default_reason: str = "other") -> dict[str, Column]:
    """Status, rejection type, reason and time, all read off one normalised code."""
    from ..functions.codes import code_map

    kind = code_map(code, rejection_type)
    return {
        "status": code_map(code, status, default_status),
        "rejection_type": kind,
        "rejection_reason": F.coalesce(code_map(code, rejection_reason), F.when(kind.isNotNull(), default_reason)),
        "rejected_at": F.when(kind.isNotNull(), at),
    }


def merge_stages(stages: DataFrame, keys: Sequence[str], status: str, ts: str, ranking: Sequence[str]) -> DataFrame:
    """The furthest stage per key from several link tables, newest first within a stage."""
    return keep_first(stages, keys, [priority(status, ranking), F.col(ts).desc_nulls_last()])


def last_time(df: DataFrame, key: str, keep: Column, ts: str, name: str) -> DataFrame:
    """The last time a key had a given status."""
    return one_per_key(df.where(keep), [F.col(key)], F.max(ts).alias(name))


def override_by_link(df: DataFrame, keys: Sequence[str], links: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose keys appear in ``links`` take ``value``; the others keep their own."""
    marks = one_per_key(links.dropna(subset=list(keys)), [F.col(k) for k in keys]).withColumn("_linked", F.lit(True))
    joined = df.join(marks, list(keys), "left")
    return joined.withColumn(column, F.when(F.col("_linked"), value).otherwise(F.col(column))).drop("_linked")


def project_state(code: Column, states: Mapping[str, Sequence[str]], reasons: Mapping[str, Sequence[str]],
                  closed_at: Column, updated_at: Column, default_state: str = "closed",
                  default_reason: str = "worked_lost", stale: Column | None = None) -> dict[str, Column]:
    """State, close reason and close time of a project from its status text and, where given, its age."""
    from ..functions.codes import code_groups

    state = code_groups(code, states, default_state)
    if stale is not None:
        state = F.when(stale, "closed").otherwise(state)
    closed = state == "closed"
    return {
        "state": state,
        "close_reason": F.when(closed, code_groups(code, reasons, default_reason)),
        "closed_at": F.when(closed, F.coalesce(closed_at, updated_at)),
    }
