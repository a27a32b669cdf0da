"""Key mapping, lookups and entity matching as equi joins.

Joins carry no broadcast hint: Spark broadcasts a side when its measured size is under the session threshold, and
sorts or splits skewed partitions beyond it. Reference sides are reduced to one row per key before they are joined
on anything but a unique id, so no join pairs up two large groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Key = Column | str


def _c(value: Key) -> Column:
    return F.col(value) if isinstance(value, str) else value


def one_per_key(df: DataFrame, keys: Sequence[Column], *aggregates: Column) -> DataFrame:
    """One row per key, for use as the looked-up side of a join; without aggregates the distinct keys.

    The keys are grouped as one struct and taken apart afterwards. Spark then exchanges the small grouped side once
    more for the join, and the join's inputs are plain exchanges, which is what lets it split a hot key of the other
    side over many tasks. Grouping on the join keys themselves would save that exchange and lose the splitting.
    """
    packed = F.struct(*keys).alias("_keys")
    grouped = df.groupBy(packed).agg(*aggregates) if aggregates else df.select(packed).distinct()
    return grouped.select("_keys.*", *[c for c in grouped.columns if c != "_keys"])


def fk_map(df: DataFrame, key: Key, ref: DataFrame, value: str, name: str, ref_key: str = "id",
           default: Column | str | None = None, policy: str = "default", unique: bool = True) -> DataFrame:
    """Add ``name``: the ``value`` of the referenced row.

    ``policy``: ``default`` keeps unmatched rows with the default (NULL without one); ``exclude`` drops them.
    ``ref`` has one row per ``ref_key``, as built tables do, so the row count never grows. Where that is not certain, ``unique``
    is false: of several rows of a key the one with the smallest value is taken.
    """
    lookup = ref.select(F.col(ref_key).alias("_fk"), F.col(value).alias("_fv"))
    if not unique:
        lookup = one_per_key(lookup.where("_fk IS NOT NULL"), [F.col("_fk")], F.min("_fv").alias("_fv"))
    how = "inner" if policy == "exclude" else "left"
    joined = df.join(lookup, _c(key) == F.col("_fk"), how)
    found = F.col("_fv")
    if policy != "exclude" and default is not None:
        found = F.coalesce(found, default if isinstance(default, Column) else F.lit(default))
    kept = [F.col(c) for c in df.columns if c != name]
    return joined.select(*kept, found.alias(name))


def drop_orphans(df: DataFrame, key: Key, ref: DataFrame, ref_key: str = "id") -> DataFrame:
    """Rows whose key exists in ``ref``; nothing is added. ``ref`` has one row per key."""
    keys = ref.select(F.col(ref_key).alias("_fk"))
    return df.join(keys, _c(key) == F.col("_fk"), "left_semi")


def exclude(df: DataFrame, key: Key, ref: DataFrame, ref_key: str = "id", unique: bool = False) -> DataFrame:
    """Rows whose key does not exist in ``ref``. A row without a key stays.

    ``unique`` says that ``ref`` has one row per key, so that its keys need no grouping.
    """
    known = ref.where(F.col(ref_key).isNotNull())
    keys = known.select(F.col(ref_key).alias("_fk")) if unique else one_per_key(known, [F.col(ref_key).alias("_fk")])
    return df.join(keys, _c(key) == F.col("_fk"), "left_anti")


def keep_any(df: DataFrame, key: Key, *refs: tuple[DataFrame, str]) -> DataFrame:
    """Rows whose key exists in at least one of the relations.

    Activity tables repeat their keys; they are reduced to distinct keys before the join, since a semi join cannot
    split a hot key of its right side.
    """
    keys = reduce(DataFrame.union, [r.select(F.col(k).alias("_fk")) for r, k in refs])
    keys = one_per_key(keys, [F.col("_fk")])
    return df.join(keys, _c(key) == F.col("_fk"), "left_semi")


def exists_flag(df: DataFrame, key: Key, ref: DataFrame, ref_key: str, name: str) -> DataFrame:
    """Whether the key exists in ``ref``, as a column."""
    keys = one_per_key(ref.where(F.col(ref_key).isNotNull()), [F.col(ref_key).alias("_fk")])
    joined = df.join(keys, _c(key) == F.col("_fk"), "left")
    return joined.withColumn(name, F.col("_fk").isNotNull()).drop("_fk")


def lookup_by_text(df: DataFrame, key: Key, ref: DataFrame, ref_text: Key, values: dict[str, str]) -> DataFrame:
    """Join on trimmed lower-case text. ``values``: new column -> column of ``ref``; the smallest id wins a tie.

    The first entry of ``values`` names the id that decides between rows of ``ref`` with the same text.
    """
    def norm(c: Key) -> Column:
        return F.nullif(F.lower(F.trim(_c(c).cast("string"))), F.lit(""))

    columns = list(values.values())
    named = ref.select(norm(ref_text).alias("_text"), F.struct(*columns).alias("_row")).where("_text IS NOT NULL")
    best = one_per_key(named, [F.col("_text")], F.min("_row").alias("_row"))
    joined = df.join(best, norm(key) == F.col("_text"), "left")
    return joined.select(*df.columns, *[F.col(f"_row.{src}").alias(new) for new, src in values.items()])


def lookup_chain(df: DataFrame, key: Key, ref: DataFrame, ref_keys: Sequence[Key], value: str, name: str,
                 default: Column | None = None) -> DataFrame:
    """Look a key up by the first reference column that knows it (id, then name, ...).

    The reference columns become one (rank, key) list with the smallest value per key, so one join answers all.
    """
    entries = F.explode(F.array(*[F.struct(F.lit(i).alias("rank"), _c(k).cast("string").alias("key"),
                                           F.col(value).alias("value")) for i, k in enumerate(ref_keys)]))
    known = ref.select(entries.alias("_e")).select("_e.*").where("key IS NOT NULL")
    best = one_per_key(known, [F.col("key").alias("_key")], F.min(F.struct("rank", "value")).alias("_best"))
    joined = df.join(best, _c(key).cast("string") == F.col("_key"), "left")
    found = F.col("_best.value") if default is None else F.coalesce(F.col("_best.value"), default)
    return joined.select(*df.columns, found.alias(name))


def match_any_key(left: DataFrame, left_id: str, right: DataFrame, right_id: str,
                  keys: Sequence[tuple[str, Key, Key]]) -> DataFrame:
    """For each left row the smallest right id that shares any key: (left id, match id), matched rows only.

    ``keys``: (kind, left expression, right expression). Blank keys match nothing. Each side becomes one long
    (kind, key) list; the right one keeps its smallest id per key, so a key shared by huge groups on both sides
    costs one row per left row, and never their product. Links are pairwise: no chain of matches is followed.
    """
    def long(df: DataFrame, row_id: str, exprs: Sequence[tuple[str, Key]]) -> DataFrame:
        cells = [F.struct(F.lit(kind).alias("kind"), F.nullif(F.trim(_c(e).cast("string")), F.lit("")).alias("key"))
                 for kind, e in exprs]
        return (df.select(F.col(row_id).alias("_id"), F.explode(F.array(*cells)).alias("_k"))
                .select("_id", "_k.kind", "_k.key").where("key IS NOT NULL"))

    lookup = one_per_key(long(right, right_id, [(k, r) for k, _, r in keys]), [F.col("kind"), F.col("key")],
                         F.min("_id").alias("_match"))
    probe = long(left, left_id, [(k, lft) for k, lft, _ in keys])
    return (probe.join(lookup, ["kind", "key"]).groupBy(F.col("_id").alias(left_id))
            .agg(F.min("_match").alias("match_id")))


def match_id_or_external(left: DataFrame, row_id: str, own_key: Key, external_key: Key, right: DataFrame,
                         right_id: str, right_external: Key) -> DataFrame:
    """Match by id, or by the external reference for rows without an id: (row id, match id), matched rows only.

    A left row takes exactly one of the two ways, so the two equi joins are disjoint.
    """
    by_id = (left.where(_c(own_key).isNotNull()).select(row_id, _c(own_key).alias("_k"))
             .join(right.select(F.col(right_id).alias("match_id")), F.col("_k") == F.col("match_id"))
             .select(row_id, "match_id"))
    known = right.select(_c(right_external).alias("_x"), F.col(right_id).alias("_id")).where("_x IS NOT NULL")
    externals = one_per_key(known, [F.col("_x")], F.min("_id").alias("match_id"))
    by_external = (left.where(_c(own_key).isNull()).select(row_id, _c(external_key).alias("_k"))
                   .join(externals, F.col("_k") == F.col("_x")).select(row_id, "match_id"))
    return by_id.unionByName(by_external)


def survivor_key(df: DataFrame, key: str, duplicates: DataFrame, duplicate: str = "contact_id",
                 survivor: str = "candidate_id") -> DataFrame:
    """Point rows of a duplicate person at the surviving one. One link is followed: ``chains.survivors`` gives a map whose links
    lead to the end of their chains."""
    mapping = one_per_key(duplicates, [F.col(duplicate).alias("_dup")], F.min(survivor).alias("_survivor"))
    joined = df.join(mapping, F.col(key) == F.col("_dup"), "left")
    return joined.withColumn(key, F.coalesce("_survivor", key)).drop("_dup", "_survivor")


def with_constant(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a relation of one row; the query fails if it has none or several."""
    counted = one_row.agg(F.count(F.lit(1)).alias("n"), F.max(F.struct(*one_row.columns)).alias("row"))
    message = F.concat(F.lit("a constant relation has to have one row, it has "), F.col("n").cast("string"))
    only = counted.select(F.when(F.col("n") == 1, F.col("row")).otherwise(F.raise_error(message)).alias("row")).select("row.*")
    return df.crossJoin(F.broadcast(only))


def nearest_in_time(left: DataFrame, group: str, left_ts: str, right: DataFrame, right_ts: str, right_id: str,
                    name: str, right_group: str | None = None) -> DataFrame:
    """For each left row the right row of its group nearest in time, by whole seconds; on a tie the largest id.

    Distances depend only on (group, second), so both sides are first reduced to distinct seconds. Neighbours are
    found inside day slices of a group, and across days from one row per group and day. The largest window thus
    holds the seconds of one day, or the active days of one group, however many rows the group has.
    """
    right_group = right_group or group
    seconds = (left.select(F.col(group).alias("_g"), F.unix_seconds(F.col(left_ts).cast("timestamp")).alias("_s"))
               .where("_g IS NOT NULL AND _s IS NOT NULL"))
    points = (right.select(F.col(right_group).alias("_g"),
                           F.unix_seconds(F.col(right_ts).cast("timestamp")).alias("_s"),
                           F.col(right_id).alias("_id"))
              .where("_g IS NOT NULL AND _s IS NOT NULL AND _id IS NOT NULL"))
    marks = (points.withColumn("_left", F.lit(False))
             .unionByName(seconds.withColumn("_left", F.lit(True)), allowMissingColumns=True)
             .groupBy("_g", "_s").agg(F.max("_id").alias("_id"), F.max("_left").alias("_left"))
             .withColumn("_day", F.floor(F.col("_s") / 86400))
             .withColumn("_hit", F.when(F.col("_id").isNotNull(), F.struct("_s", "_id"))))
    def last_hit(value: str, keys: Sequence[str], order: Column, until: int) -> Column:
        # the next hit is the last one in reverse order: only frames that grow take linear time
        window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, until)
        return F.last(value, True).over(window)

    day = ["_g", "_day"]
    inside = marks.select(
        "_g", "_day", "_s", "_left", last_hit("_hit", day, F.col("_s").asc(), 0).alias("_prev"),
        last_hit("_hit", day, F.col("_s").desc(), 0).alias("_next")).where("_left")
    days = marks.groupBy("_g", "_day").agg(F.min("_hit").alias("_lo"), F.max("_hit").alias("_hi"))
    across = days.select(
        "_g", "_day", last_hit("_hi", ["_g"], F.col("_day").asc(), -1).alias("_before"),
        last_hit("_lo", ["_g"], F.col("_day").desc(), -1).alias("_after"))
    found = inside.join(across, ["_g", "_day"])
    candidates = F.filter(F.array("_prev", "_next", "_before", "_after"), lambda h: h.isNotNull())
    ranked = F.transform(candidates, lambda h: F.struct((-F.abs(h["_s"] - F.col("_s"))).alias("closeness"),
                                                        h["_id"].alias("id")))
    best = found.select("_g", "_s", F.array_max(ranked)["id"].alias(name)).where(F.col(name).isNotNull())
    moment = F.unix_seconds(F.col(left_ts).cast("timestamp"))
    joined = left.join(best, (F.col(group) == F.col("_g")) & (moment == F.col("_s")), "left")
    return joined.select(*left.columns, name)
