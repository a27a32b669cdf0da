"""Writing canonical tables.

A refresh is written beside the table and takes its place when it is whole: the folder of a run that died half-way is never
read, and what was there before stays. Between the two renames of a swap the table's own folder is missing; its
previous state then stands in a folder beside it, and ``current_path``, which every reader uses, finds it there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MARK = "_SUCCESS"  # written last, when all files of a folder are there


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _beside(spark: SparkSession, path: str, kind: str) -> list[Any]:
    """Folders next to a table that a refresh has left behind, the newest last."""
    files, place = _files(spark, path)
    parent, start = place.getParent(), f"_{place.getName()}-{kind}-"
    found = [f for f in files.listStatus(parent) if f.getPath().getName().startswith(start)] if files.exists(parent) else []
    return [f.getPath() for f in sorted(found, key=lambda f: f.getModificationTime())]


def current_path(spark: SparkSession, path: str) -> str:
    """Where a table's rows are: its own folder, or, if a swap was cut short, the last whole folder before it."""
    files, place = _files(spark, path)
    if not files.exists(place):
        for old in reversed(_beside(spark, path, "previous")):
            if files.exists(spark._jvm.org.apache.hadoop.fs.Path(old, _MARK)):
                return old.toString()
    return path


def overwrite_table(df: DataFrame, path: str, cluster_by: Sequence[str] = (), files: int | None = None,
                    watch: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Full refresh of one table. One writer a table; a table may be rebuilt from its own rows.

    ``cluster_by`` gives the rows the physical order a final ORDER BY would, by range partitioning: the key
    ranges are balanced by sampling and no task sorts the whole table. ``watch`` sees the rows as they are written.
    """
    if cluster_by:
        ranged = df.repartitionByRange(files, *cluster_by) if files else df.repartitionByRange(*cluster_by)
        df = ranged.sortWithinPartitions(*cluster_by)
    spark = df.sparkSession
    system, place = _files(spark, path)
    run, paths = uuid.uuid4().hex, spark._jvm.org.apache.hadoop.fs.Path
    staged, previous = (paths(place.getParent(), f"_{place.getName()}-{kind}-{run}") for kind in ("staging", "previous"))
    held = paths(current_path(spark, path))  # the folder itself, or what a swap that was cut short has left
    (df if watch is None else watch(df)).write.parquet(staged.toString())
    if not system.exists(paths(staged, _MARK)):
        system.create(paths(staged, _MARK)).close()
    if system.exists(place) and not system.rename(place, previous):
        raise OSError(f"{path} cannot be moved aside; its rows are as they were")
    if not system.rename(staged, place):
        raise OSError(f"{path} cannot be replaced; its rows are in {held if system.exists(held) else previous}")
    for kind in ("staging", "previous"):
        for left in _beside(spark, path, kind):
            system.delete(left, True)
    spark.catalog.refreshByPath(path)


@dataclass(frozen=True)
class FileRange:
    """What a written file's footer says of a column: its least and greatest value, and how many row groups and rows it has."""

    file: str
    least: Any
    greatest: Any
    groups: int
    rows: int


def file_ranges(spark: SparkSession, path: str, column: str) -> list[FileRange]:
    """The ranges of a column in the files of a table, read off their footers; data pages are not touched.

    None for both ends means that the footer does not say, or that all values are null.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    parquet = jvm.org.apache.parquet.hadoop
    out = []
    for file in sorted(spark.read.parquet(path).inputFiles()):
        reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), conf))
        try:
            blocks, ends, known = reader.getFooter().getBlocks(), [], True
            rows = sum(b.getRowCount() for b in blocks)
            for block in blocks:
                statistics = next(c.getStatistics() for c in block.getColumns() if c.getPath().toDotString() == column)
                if statistics.hasNonNullValue():
                    ends += [_plain(statistics.genericGetMin()), _plain(statistics.genericGetMax())]
                elif statistics.getNumNulls() != block.getRowCount():
                    known = False
        finally:
            reader.close()
        out.append(FileRange(file, *((min(ends), max(ends)) if ends and known else (None, None)), len(blocks), rows))
    return out


def _plain(value: Any) -> Any:
    return value.toStringUsingUTF8() if hasattr(value, "toStringUsingUTF8") else value


def is_clustered(ranges: Sequence[FileRange]) -> bool:
    """Whether the files hold ranges that follow each other and share no more than their ends."""
    held = sorted((r for r in ranges if r.least is not None), key=lambda r: (r.least, r.greatest))
    return all(a.greatest <= b.least for a, b in zip(held, held[1:], strict=False))


def read_range(spark: SparkSession, path: str, column: str, low: Any, high: Any) -> DataFrame:
    """The rows of a table whose ``column`` lies from ``low`` to ``high`` (numbers or texts), from the files that can hold such rows
    and no others: their footers are looked at first."""
    path = current_path(spark, path)
    ranges = file_ranges(spark, path, column)
    files = [r.file for r in ranges if r.rows and (r.least is None or (r.least <= high and r.greatest >= low))]
    schema = spark.read.parquet(path).schema
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return rows.where(F.col(column).between(low, high))


@dataclass
class Outputs:
    """The tables of a run, in the order they were built.

    With a folder each table is written when it is added, and what builds on it reads the stored rows: nothing is
    computed twice, and a lost executor costs one table's work at most. Without one the tables stay lazy. ``watch`` sees
    each table's name and rows as they are written.
    """

    folder: str | None = None
    cluster_by: Mapping[str, Sequence[str]] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    watch: Callable[[str, DataFrame], DataFrame] | None = None

    def add(self, name: str, df: DataFrame) -> DataFrame:
        if self.folder is not None:
            path = f"{self.folder}/{name}"
            seen = None if self.watch is None else lambda rows: self.watch(name, rows)
            overwrite_table(df, path, self.cluster_by.get(name, ()), watch=seen)
            df = df.sparkSession.read.schema(df.schema).parquet(path)
        self.tables[name] = df
        return df
