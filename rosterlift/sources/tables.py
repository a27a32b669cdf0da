"""Reading vendor exports, seeds, numbered shards and literal relations."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sinks import current_path

# Columns of the two seed files a migration may ship.
SEEDS: dict[str, str] = {
    "user_mapping": "email string, name string, id bigint, atlas_id string",
    "custom_attribute_map": "name string, of string, multiple_values boolean, usercontact_column string",
}


@dataclass
class TableReader:
    """Reads the tables of one export, from a folder of parquet tables or from a catalog database.

    Reads are lazy and remembered, so builders sharing a table share one relation.
    """

    spark: SparkSession
    folder: str | None = None
    database: str | None = None
    suffix: str = ".parquet"
    _seen: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def __call__(self, name: str) -> DataFrame:
        if name not in self._seen:
            self._seen[name] = self._read(name)
        return self._seen[name]

    def _read(self, name: str) -> DataFrame:
        if self.folder is not None:
            return self.spark.read.parquet(current_path(self.spark, f"{self.folder}/{name}{self.suffix}"))
        return self.spark.table(f"{self.database}.{name}" if self.database else name)

    def names(self) -> list[str]:
        """Every table of the folder or database."""
        if self.folder is None:
            return [t.name for t in self.spark.catalog.listTables(self.database)]
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
        return [n.removesuffix(self.suffix) for n in found if n.endswith(self.suffix)]

    def exists(self, name: str) -> bool:
        if name in self._seen:
            return True
        if self.folder is None:
            return self.spark.catalog.tableExists(f"{self.database}.{name}" if self.database else name)
        try:
            self(name)
        except AnalysisException:
            return False
        return True


@dataclass(frozen=True)
class SourceMap:
    """How one vendor table feeds a builder: input name -> SQL expression, plus the rows to keep."""

    table: str
    columns: Mapping[str, str]
    keep: str | None = None

    def read(self, read: Callable[[str], DataFrame]) -> DataFrame:
        df = read(self.table)
        if self.keep:
            df = df.where(self.keep)
        return df.selectExpr(*[f"{expr} AS {name}" for name, expr in self.columns.items()])


def read_seed(spark: SparkSession, path: str, seed: str) -> DataFrame:
    """A seed CSV with its fixed schema; no inference pass."""
    return spark.read.csv(path, header=True, schema=SEEDS[seed])


def empty_relation(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = (3, 5, 10, 19)


def common_type(kinds: Sequence[T.DataType]) -> T.DataType:
    """The narrowest type that holds the values of all: whole numbers widen, with fractions they become decimals or doubles,
    days become times, and what has nothing else in common becomes text."""
    kinds = [k for k in dict.fromkeys(kinds) if not isinstance(k, T.NullType)]
    if not kinds:
        return T.StringType()
    if len(kinds) == 1:
        return kinds[0]
    if all(isinstance(k, _WHOLE) for k in kinds):
        return max(kinds, key=lambda k: _WHOLE.index(type(k)))
    if all(isinstance(k, (*_WHOLE, T.DecimalType)) for k in kinds):
        sizes = [(k.precision - k.scale, k.scale) if isinstance(k, T.DecimalType) else (_DIGITS[_WHOLE.index(type(k))], 0) for k in kinds]
        before, after = max(a for a, _ in sizes), max(b for _, b in sizes)
        return T.DecimalType(before + after, after) if before + after <= 38 else T.DoubleType()
    if all(isinstance(k, T.NumericType) for k in kinds):
        return T.DoubleType()
    if all(isinstance(k, (T.DateType, T.TimestampType)) for k in kinds):
        return T.TimestampType()
    return T.StringType()


def reconcile(shards: Mapping[str, DataFrame]) -> tuple[dict[str, T.DataType], list[tuple[str, str, str, str]]]:
    """The common type of every column of some shards, in order of appearance, and what that widens: (column, shard, its type,
    the common type)."""
    held: dict[str, dict[str, T.DataType]] = {}
    for name, df in shards.items():
        for f in df.schema.fields:
            held.setdefault(f.name, {})[name] = f.dataType
    common = {column: common_type(list(kinds.values())) for column, kinds in held.items()}
    widened = [(column, name, kind.simpleString(), common[column].simpleString())
               for column, kinds in held.items() for name, kind in kinds.items() if kind != common[column]]
    return common, widened


def union_shards(shards: Mapping[str, DataFrame], keep: Mapping[str, Column] | None = None) -> DataFrame:
    """One relation from named shards, each tagged with the table it came from and filtered by its own predicate.

    A column that not all shards have is null elsewhere; one whose types differ has their common type (see ``reconcile``, which also
    lists what was widened).
    """
    keep = keep or {}
    common, widened = reconcile(shards)
    parts = []
    for name, df in shards.items():
        part = df.where(keep[name]) if name in keep else df
        wide = {column: F.col(column).cast(common[column]) for column, shard, _, _ in widened if shard == name}
        part = part.withColumns(wide) if wide else part
        parts.append(part.withColumn("source_table", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_shards(reader: TableReader, numbered: str, fallback: str, schema: str) -> DataFrame:
    """Union of all numbered shards there are (``numbered`` with digits for ``{}``), else the single table, else no rows."""
    shape = re.compile(r"(\d+)".join(re.escape(part) for part in numbered.split("{}")))
    names = sorted((n for n in reader.names() if shape.fullmatch(n)), key=lambda n: int(shape.fullmatch(n)[1]))
    if not names and reader.exists(fallback):
        names = [fallback]
    if not names:
        return empty_relation(reader.spark, schema).withColumn("source_table", F.lit(None).cast("string"))
    return union_shards({name: reader(name) for name in names})


def literal_relation(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence[Any]]) -> DataFrame:
    """A code list held in the job itself; its size is fixed by the source text, so joins may broadcast it."""
    cells = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows])
    return spark.range(1).select(F.inline(cells))


def constant_row(spark: SparkSession, **values: Any) -> DataFrame:
    return spark.range(1).select(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in values.items()])
