"""Comparing two tables: schema, counts, keys and fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .sources.tables import literal_relation

# Columns tried as row key, in order.
LIKELY_KEYS = ("id", "person_identity_id", "person_id", "company_id")


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """One line per column that one side lacks or that differs in type or nullability."""
    a = {f.name: (f.dataType.simpleString(), f.nullable) for f in left.schema.fields}
    b = {f.name: (f.dataType.simpleString(), f.nullable) for f in right.schema.fields}
    rows = []
    for name in sorted(a.keys() | b.keys()):
        if a.get(name) != b.get(name):
            kind = "only_left" if name not in b else "only_right" if name not in a else "type"
            rows.append((name, kind, *[_described(side.get(name)) for side in (a, b)]))
    columns = ("column_name", "difference", "left_type", "right_type")
    if not rows:
        return left.sparkSession.createDataFrame([], ", ".join(f"{c} string" for c in columns))
    return literal_relation(left.sparkSession, columns, rows)


def _described(column: tuple[str, bool] | None) -> str | None:
    if column is None:
        return None
    return column[0] if column[1] else f"{column[0]} not null"


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    return sorted(set(left.columns) & set(right.columns))


def likely_key(left: DataFrame, right: DataFrame) -> str | None:
    shared = common_columns(left, right)
    return next((k for k in LIKELY_KEYS if k in shared), None)


def count_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    sides = left.select(F.lit(1).alias("l")).unionByName(right.select(F.lit(0).alias("l")))
    counts = sides.agg(F.count_if(F.col("l") == 1).alias("n_left"), F.count_if(F.col("l") == 0).alias("n_right"))
    return counts.withColumn("difference", F.abs(F.col("n_left") - F.col("n_right")))


def _comparable(df: DataFrame, column: str) -> Column:
    """Texts without outer white space; other values as they are."""
    if isinstance(df.schema[column].dataType, StringType):
        return F.regexp_replace(F.col(column), r"^\s+|\s+$", "").alias(column)
    return F.col(column)


def _both_sides(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of both sides: key, is_left, the comparable cells and their hash."""
    columns = [c for c in common_columns(left, right) if c != key]

    def side(df: DataFrame, is_left: bool) -> DataFrame:
        cells = F.struct(*[_comparable(df, c).cast("string").alias(c) for c in columns]) if columns else F.struct(F.lit("").alias("_"))
        rows = df.select(F.col(key).alias("key"), F.lit(is_left).alias("is_left"), cells.alias("cells"))
        return rows.withColumn("hash", F.xxhash64("cells"))
    return side(left, True).unionByName(side(right, False))


def compared_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row per key: how many rows each side has, and whether these are the same rows.

    Every row of a repeated key counts: the rows of a key are compared as multisets, by their hashes. Only keys and hashes
    are exchanged, and both sides go through groupings with pre-aggregation, so a key that repeats on both sides is counted
    rather than multiplied.
    """
    hashes = _both_sides(left, right, key).groupBy("key", "hash").agg(
        F.count_if("is_left").alias("n_left"), F.count_if(~F.col("is_left")).alias("n_right"))
    return hashes.groupBy("key").agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"),
                                     F.max(F.col("n_left") != F.col("n_right")).alias("differs"))


def differing_rows(left: DataFrame, right: DataFrame, key: str, buckets: int = 4096, levels: int = 2) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides that may differ, for tables that are nearly equal: all other comparisons can start from these.

    Rows fall into buckets by the hash of their key. Two sides of a bucket agree if they have as many rows and the same two
    128-bit sums of row hashes; only buckets that do not are looked into again, by other bits of the hash. Of equal tables
    nothing but a digest for each bucket is exchanged, and every level reads the tables once more. A key whose rows differ has all
    its rows in the result, so it has the same differences there.
    """
    columns = [c for c in common_columns(left, right) if c != key]

    def spread(level: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(level), F.col(key).cast("string")), F.lit(buckets)).cast("int")

    def digests(a: DataFrame, b: DataFrame, level: int) -> DataFrame:
        def side(df: DataFrame, sign: int) -> DataFrame:
            cells = [F.col(key).cast("string"), *[F.coalesce(F.concat(F.lit("+"), _comparable(df, c).cast("string")), F.lit("-")) for c in columns]]
            sums = [F.xxhash64(F.lit(seed), *cells).cast("decimal(20,0)") * sign for seed in (1, 2)]
            return df.select(spread(level).alias("_bucket"), F.lit(sign).alias("n"), *[h.alias(f"h{i}") for i, h in enumerate(sums)])
        both = side(a, 1).unionByName(side(b, -1)).groupBy("_bucket").agg(*[F.sum(c).alias(c) for c in ("n", "h0", "h1")])
        return both.where("n <> 0 OR h0 <> 0 OR h1 <> 0").select("_bucket")

    for level in range(levels):
        found = F.broadcast(digests(left, right, level))  # at most one small row for each bucket
        left, right = (df.withColumn("_bucket", spread(level)).join(found, "_bucket", "left_semi").drop("_bucket") for df in (left, right))
    return left, right


def _unmatched_values(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Of common keys that differ, the values of each column that one side has more often: key, column_name, value, surplus.

    Wide rows are read again for those keys only.
    """
    columns = [c for c in common_columns(left, right) if c != key]
    differing = compared_keys(left, right, key).where("n_left > 0 AND n_right > 0 AND differs").select(F.col("key").alias("_key"))
    rows = _both_sides(left, right, key).join(differing, F.col("key").eqNullSafe(F.col("_key")), "left_semi")
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"cells.{c}").alias("value")) for c in columns]
    long = rows.select("key", "is_left", F.inline(F.array(*cells)))
    surplus = F.sum(F.when(F.col("is_left"), 1).otherwise(-1)).alias("surplus")
    return long.groupBy("key", "column_name", "value").agg(surplus).where("surplus <> 0")


def key_diff(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys missing on one side or repeated on either: key, difference, n_left, n_right."""
    counts = (left.select(F.col(key).alias("key"), F.lit(True).alias("is_left"))
              .unionByName(right.select(F.col(key).alias("key"), F.lit(False).alias("is_left")))
              .groupBy("key").agg(F.count_if("is_left").alias("n_left"), F.count_if(~F.col("is_left")).alias("n_right")))
    difference = (F.when(F.col("n_right") == 0, "only_left").when(F.col("n_left") == 0, "only_right")
                  .when((F.col("n_left") > 1) | (F.col("n_right") > 1), "repeated"))
    return (counts.withColumn("difference", difference).where("difference IS NOT NULL")
            .select("key", "difference", "n_left", "n_right"))


def field_diff(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Per common column with differences: how many common keys differ, and their share in percent."""
    common = compared_keys(left, right, key).agg(F.count_if((F.col("n_left") > 0) & (F.col("n_right") > 0)).alias("n"))
    keys = _unmatched_values(left, right, key).select("key", "column_name").distinct()
    counts = keys.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_different"))
    # A row for each column, and one without a name for the number of keys.
    every = counts.unionByName(common.select(F.lit(None).cast("string").alias("column_name"), F.col("n").alias("n_different")))
    lines = every.agg(F.collect_list(F.struct("column_name", "n_different")).alias("lines"))
    n = F.filter("lines", lambda x: x["column_name"].isNull())[0]["n_different"]
    named = F.filter("lines", lambda x: x["column_name"].isNotNull())
    return lines.select(F.inline(F.transform(named, lambda x: F.struct(
        x["column_name"].alias("column_name"), x["n_different"].alias("n_different"), F.round(x["n_different"] * 100 / n, 2).alias("percent")))))


def field_samples(left: DataFrame, right: DataFrame, key: str, n: int | None = 5) -> DataFrame:
    """A sample for a report: up to ``n`` differing keys per column (all for None), in key order, with a value of each side.

    Of the values that a side has more often than the other the smallest is shown.
    """
    values = _unmatched_values(left, right, key).groupBy("column_name", "key").agg(
        F.min(F.when(F.col("surplus") > 0, F.col("value"))).alias("left_value"),
        F.min(F.when(F.col("surplus") < 0, F.col("value"))).alias("right_value"))
    ranked = values.withColumn("n", F.row_number().over(Window.partitionBy("column_name").orderBy("key")))
    return ranked if n is None else ranked.where(F.col("n") <= n)


def multiset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Without a key: distinct rows that occur more often on one side, with both counts."""
    columns = common_columns(left, right)
    both = (left.select(*[_comparable(left, c) for c in columns], F.lit(True).alias("_left"))
            .unionByName(right.select(*[_comparable(right, c) for c in columns], F.lit(False).alias("_left"))))
    counts = both.groupBy(*columns).agg(F.count_if("_left").alias("n_left"), F.count_if(~F.col("_left")).alias("n_right"))
    return counts.where("n_left <> n_right")


def diff_summary(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One line: keys only on one side, keys whose rows differ, columns that differ, and the schema differences."""
    common = (F.col("n_left") > 0) & (F.col("n_right") > 0)
    row = compared_keys(left, right, key).agg(
        F.abs(F.sum("n_left") - F.sum("n_right")).alias("row_count_difference"),
        F.count_if(F.col("n_right") == 0).alias("n_only_left"), F.count_if(F.col("n_left") == 0).alias("n_only_right"),
        F.count_if(common).alias("n_common"), F.count_if(common & F.col("differs")).alias("n_rows_different"))
    columns = _unmatched_values(left, right, key).agg(F.count_distinct("column_name").cast("int").alias("n_columns_different"))
    n_schema = sum(left.schema[c].dataType != right.schema[c].dataType for c in common_columns(left, right))
    both = row.unionByName(columns, allowMissingColumns=True)  # one row each, made one
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumn("n_type_differences", F.lit(n_schema))
