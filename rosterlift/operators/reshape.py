"""Wide to long, lists to rows, settings to columns, rows to text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .slices import SLICES, placed


def unpivot(df: DataFrame, keep: Sequence[str], branches: Sequence[Mapping[str, Column]]) -> DataFrame:
    """One output row per input row and branch, from a single scan.

    Each branch gives the same column names; a branch is skipped for rows where its ``value`` is NULL.
    """
    names = list(branches[0])
    cells = F.array(*[F.struct(*[b[n].alias(n) for n in names]) for b in branches])
    return df.select(*keep, F.inline(cells)).where(F.col("value").isNotNull())


def explode_list(df: DataFrame, column: str, name: str, separators: str = ",;") -> DataFrame:
    """One row per item of a delimiter list, trimmed, blank items dropped; any number of items."""
    pattern = "[" + "".join("\\" + s if s in "|/\\]^-" else s for s in separators) + "]"
    items = df.withColumn(name, F.explode(F.split(F.col(column), pattern)))
    return items.withColumn(name, F.trim(name)).where(F.col(name) != "")


def settings_to_columns(df: DataFrame, key: str, setting: str, value: str, names: Sequence[str]) -> DataFrame:
    """One column per known setting name, in one grouped pass."""
    return df.groupBy(key).agg(*[F.max(F.when(F.col(setting) == n, F.col(value))).alias(n) for n in names])


def ordered_text(df: DataFrame, keys: Sequence[str], order: Sequence[str], piece: Column, separator: str,
                 name: str, slices: int = SLICES) -> DataFrame:
    """The pieces of each key joined in order, nulls first, pieces of one place in their own order.

    Pieces are joined within slices of the order first, then the slices' texts, so no task sorts a whole group; what comes
    together for a key is one text per slice. The result cell is the whole text of its key, so its size is that of the
    output. NULL pieces are skipped.
    """
    rows = df.withColumn("_piece", piece).where("_piece IS NOT NULL")
    # Nulls first, as in the sort of the pieces; a piece's first characters sort like the piece.
    by = [x for c in order for x in (F.col(c).isNotNull(), F.col(c))] + [F.substring("_piece", 1, 32)]
    rows = placed(rows.select(*dict.fromkeys([*keys, *order]), "_piece"), keys, by, slices)

    def joined(value: Column, *by: Column | str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*by, value.alias("_text")))), lambda p: p["_text"]), separator)

    parts = rows.groupBy("_key", "_slice").agg(joined(F.col("_piece"), *order).alias("_part"))
    return parts.groupBy("_key").agg(joined(F.col("_part"), "_slice").alias(name)).select("_key.*", name)


def union_all(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_distinct(*parts: DataFrame) -> DataFrame:
    return union_all(*parts).distinct()


def tagged_values(parts: Mapping[str, tuple[DataFrame, Column]], tag: str = "alias") -> DataFrame:
    """Distinct (tag, value) pairs of several code columns; blank values dropped.

    Columns of one table go through a single scan: parts that share a relation are unpivoted together.
    """
    by_table: dict[int, tuple[DataFrame, list[tuple[str, Column]]]] = {}
    for name, (df, value) in parts.items():
        by_table.setdefault(id(df), (df, []))[1].append((name, value))
    longs = []
    for df, values in by_table.values():
        branches = [{tag: F.lit(name), "value": F.nullif(F.trim(v.cast("string")), F.lit(""))} for name, v in values]
        longs.append(unpivot(df, [], branches))
    return union_all(*longs).distinct()
