"""Checks across tables and against the source export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.contact import identity_shape
from ..operators.joins import fk_map
from .predicates import holds_several


def null_ids(df: DataFrame) -> DataFrame:
    """Rows with a NULL per ``..atlas_id`` or ``atlas_..._id`` column, from one aggregate."""
    ids = [c for c in df.columns if c.endswith("atlas_id") or (c.startswith("atlas_") and c.endswith("_id"))]
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in ids])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_bad")) for c in ids]
    return row.select(F.inline(F.array(*cells)))


def orphans(df: DataFrame, key: str, ref: DataFrame, ref_key: str) -> DataFrame:
    """Key values that point at nothing, with the number of rows that carry them.

    Keys are counted first, so the join sees each value once.
    """
    held = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("missing_key")).agg(
        F.count(F.lit(1)).alias("n_rows"))
    known = ref.select(F.col(ref_key).alias("missing_key"))
    return held.join(known, "missing_key", "left_anti")


def count_variance(pairs: Mapping[str, tuple[DataFrame, DataFrame, float]]) -> DataFrame:
    """Row counts of source and target per table: (source, target, tolerance). A deviation beyond it fails."""
    out = None
    for name, (source, target, tolerance) in pairs.items():
        n_source = source.agg(F.count(F.lit(1)).alias("n_source"))
        n_target = target.agg(F.count(F.lit(1)).alias("n_target"))
        line = n_source.crossJoin(n_target).select(
            F.lit(name).alias("table_name"), "n_source", "n_target",
            (F.abs(F.col("n_target") - F.col("n_source")) <= F.lit(tolerance) * F.col("n_source")).alias("passed"))
        out = line if out is None else out.unionByName(line)
    return out


def type_mismatches(identities: DataFrame, classes: Mapping[str, str]) -> DataFrame:
    """Identities whose class does not go with their type, or whose value does not look like it."""
    pairs = [F.lit(x) for pair in classes.items() for x in pair]
    expected = F.try_element_at(F.create_map(*pairs), F.col("type"))
    looks = identity_shape("value")
    wrong_class = ~F.col("class_type").eqNullSafe(expected)
    wrong_shape = F.col("type").isin("email", "phone", "linkedin") & ~looks.eqNullSafe(F.col("type"))
    return identities.groupBy("type").agg(F.count_if(wrong_class).alias("n_wrong_class"),
                                          F.count_if(wrong_shape).alias("n_wrong_shape"))


def several_values(df: DataFrame, columns: Sequence[str], urls: Sequence[str] = ()) -> DataFrame:
    """Per column, the rows whose text holds a list instead of one value; ``urls`` are the columns that hold addresses."""
    row = df.agg(*[F.count_if(holds_several(F.col(c), "url" if c in urls else "text")).alias(c) for c in columns])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_bad"))
                                         for c in columns])))


def lost_values(source: DataFrame, target: DataFrame, key: str, columns: Mapping[str, Column]) -> DataFrame:
    """Source values that arrived as NULL or changed: per column, the counts of lost and changed rows.

    ``columns``: target column -> the expression over the source that says what should have arrived.
    """
    expected = source.select(F.col(key), *[e.alias(f"_s_{c}") for c, e in columns.items()])
    actual = target.select(F.col(key), *[F.col(c).alias(f"_t_{c}") for c in columns])
    joined = expected.join(actual, key)
    measures = []
    for c in columns:
        s, t = F.col(f"_s_{c}"), F.col(f"_t_{c}")
        measures += [F.count_if(s.isNotNull() & t.isNull()).alias(f"_lost_{c}"),
                     F.count_if((s != t) & t.isNotNull()).alias(f"_changed_{c}")]
    row = joined.agg(*measures)
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_lost_{c}").alias("n_lost"),
                 F.col(f"_changed_{c}").alias("n_changed")) for c in columns])))


def unmapped_codes(df: DataFrame, code: Column, known: Sequence[str]) -> DataFrame:
    """Source codes the status map does not know, with their row counts."""
    counts = df.groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where(F.col("code").isNotNull() & ~F.col("code").isin(*known))


def repeated_identities(identities: DataFrame, owner: str = "person_id") -> DataFrame:
    """Values an owner holds more than once, whatever their case."""
    return (identities.groupBy(owner, F.lower("value").alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
            .where("n_rows > 1"))


def map_users(df: DataFrame, key: str, users: DataFrame, name: str, policy: str, master: Column,
              own: Mapping[str, str] | None = None) -> DataFrame:
    """Rows whose user is unknown: given to the master user, mapped by hand first, or left out."""
    if policy == "exclude":
        return fk_map(df, key, users, "atlas_id", name, policy="exclude")
    if policy == "map" and own:
        pairs = [F.lit(x) for pair in own.items() for x in pair]
        by_hand = F.try_element_at(F.create_map(*pairs), F.col(key).cast("string"))
        return fk_map(df, key, users, "atlas_id", name, default=F.coalesce(by_hand, master))
    return fk_map(df, key, users, "atlas_id", name, default=master)
