"""Running the checks of a table in as few passes as they need.

All count, fraction and min/max checks of a table share one aggregate; all uniqueness checks share one grouped pass;
samples are read only for the checks that count rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.ids import compact as _compact
from ..functions.text import shorten
from .checks import FAIL, Check, compile_checks
from .contracts import CONTRACTS, GLOBAL_RULES, matching_contract, select_tables

REPORT_SCHEMA = "table_name string, column_name string, rule string, severity string, n_bad bigint, passed boolean"
MEASURED = ("rows", "fraction", "single", "mixed")
ONE_PASS = (*MEASURED, "schema")


def _least(c: str) -> Column:
    return F.min(F.col(c).cast("string"))


def _greatest(c: str) -> Column:
    return F.max(F.col(c).cast("string"))


def _measure(check: Check) -> Column:
    if check.kind in ("rows", "fraction"):
        return F.count_if(check.bad)
    if check.kind == "single":
        return F.when(_least(check.column) != _greatest(check.column), 1).otherwise(0).cast("bigint")
    both = F.coalesce(_least(check.column) != _greatest(check.column), F.lit(False))
    return F.when(both, 0).otherwise(1).cast("bigint")


def _line(table: str, check: Check, n_bad: Column, n_rows: Column) -> Column:
    passed = n_bad <= F.lit(check.limit) * n_rows if check.kind == "fraction" else n_bad == 0
    return F.struct(F.lit(table).alias("table_name"), F.lit(check.column).alias("column_name"),
                    F.lit(check.rule).alias("rule"), F.lit(check.severity).alias("severity"),
                    n_bad.cast("bigint").alias("n_bad"), passed.alias("passed"))


def _measures(checks: Sequence[Check]) -> list[Column]:
    """Aggregates that answer all counted checks: the number of rows, then one for each check that is measured."""
    measured = [c for c in checks if c.kind in MEASURED]
    return [F.count(F.lit(1)).alias("_rows"), *[_measure(c).alias(f"_m{i}") for i, c in enumerate(measured)]]


def one_pass(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """Report lines of every check that a single aggregate can answer; schema checks ride along."""
    return _lines(df.agg(*_measures(checks)), table, checks)


def _lines(row: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    measured = [c for c in checks if c.kind in MEASURED]
    decided = [c for c in checks if c.kind == "schema"]
    lines = [_line(table, c, F.col(f"_m{i}"), F.col("_rows")) for i, c in enumerate(measured)]
    lines += [_line(table, c, F.lit(int(c.bad)), F.col("_rows")) for c in decided]
    return row.select(F.inline(F.array(*lines)))


def uniqueness(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """Repeated values of several columns or column pairs, from one scan and one grouping on (check, values).

    ``n_bad`` is rows minus distinct values for a column, and the number of repeated pairs for a pair. Counting
    starts before the shuffle, so a value repeated on a third of the rows is one row per partition.
    """
    cells = []
    for i, check in enumerate(checks):
        values = [F.col(c).cast("string") for c in check.column.split(",")]
        values = [F.lower(v) for v in values] if check.ignore_case else values
        whole = reduce(lambda a, b: a & b, [v.isNotNull() for v in values])
        cells.append(F.struct(F.lit(i).alias("i"), F.when(whole, F.array(*map(_compact, values))).alias("v")))
    groups = df.select(F.inline(F.array(*cells))).where("v IS NOT NULL").groupBy("i", "v").count()
    extra = groups.groupBy("i").agg(F.struct(F.sum(F.col("count") - 1).alias("unique"),
                                             F.count_if(F.col("count") > 1).alias("pairs")).alias("n"))
    by_check = extra.agg(F.map_from_entries(F.collect_list(F.struct("i", "n"))).alias("_m"))
    lines = [_line(table, c, F.coalesce(F.try_element_at("_m", F.lit(i))[c.kind], F.lit(0)), F.lit(0))
             for i, c in enumerate(checks)]
    return by_check.select(F.inline(F.array(*lines)))


def repeated_values(df: DataFrame, columns: Sequence[str], n: int | None = 10) -> DataFrame:
    """The most repeated combinations of the given columns: a sample of ``n`` for a report, all of them for None."""
    kept = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    counts = kept.groupBy(*columns).count().where("count > 1")
    ordered = counts.orderBy(F.col("count").desc(), *columns)
    return counts if n is None else ordered.limit(n)


def position_gaps(df: DataFrame, attribute: str, position: str) -> DataFrame:
    """Per attribute whose positions do not run 1..n: where they start and how many numbers are missing."""
    held = (df.select(F.col(attribute).alias("attribute_id"), F.col(position).cast("int").alias("position"))
            .where("attribute_id IS NOT NULL AND position IS NOT NULL"))
    spans = held.distinct().groupBy("attribute_id").agg(
        F.min("position").alias("starts_at"), F.max("position").alias("ends_at"), F.count("position").alias("n"))
    spans = spans.withColumn("n_missing", F.col("ends_at") - F.col("starts_at") + 1 - F.col("n"))
    return spans.where("starts_at <> 1 OR n_missing > 0").select("attribute_id", "starts_at", "ends_at", "n_missing")


def missing_intervals(df: DataFrame, attribute: str, position: str) -> DataFrame:
    """The gaps between held positions, one row each: attribute_id, first_missing, last_missing, n_missing.

    Neighbours are looked for within blocks of 65,536 numbers, then between the blocks that hold any, so that the largest window has
    the positions of one block or the blocks of one attribute.
    """
    held = (df.select(F.col(attribute).alias("attribute_id"), F.col(position).cast("long").alias("at"))
            .where("attribute_id IS NOT NULL AND at IS NOT NULL").distinct().withColumn("block", F.shiftright("at", 16)))
    inside = held.withColumn("then", F.lead("at").over(Window.partitionBy("attribute_id", "block").orderBy("at")))
    blocks = held.groupBy("attribute_id", "block").agg(F.min("at").alias("low"), F.max("at").alias("at"))
    across = blocks.withColumn("then", F.lead("low").over(Window.partitionBy("attribute_id").orderBy("block")))
    steps = inside.select("attribute_id", "at", "then").union(across.select("attribute_id", "at", "then")).where("then > at + 1")
    return steps.select("attribute_id", (F.col("at") + 1).alias("first_missing"), (F.col("then") - 1).alias("last_missing"),
                        (F.col("then") - F.col("at") - 1).alias("n_missing"))


def missing_positions(df: DataFrame, attribute: str, position: str, piece: int = 65536) -> DataFrame:
    """Every number missing between two held ones: (attribute_id, position). A gap is expanded in pieces of bounded size."""
    gaps = missing_intervals(df, attribute, position)
    pieces = gaps.select("attribute_id", "last_missing", F.explode(F.sequence("first_missing", "last_missing", F.lit(piece).cast("long"))).alias("begin"))
    numbers = F.sequence("begin", F.least(F.col("begin") + piece - 1, "last_missing"))
    return pieces.select("attribute_id", F.explode(numbers).alias("position")).withColumn("position", F.col("position").cast("int"))


def evaluate(df: DataFrame, table: str, rules: Mapping[str, Any] | None = None,
             global_rules: Mapping[str, Any] | None = None) -> DataFrame:
    """The report of one table: table_name, column_name, rule, severity, n_bad, passed.

    The table is read once for all counted rules and once for all uniqueness rules; check a stored table rather than
    a long plan.
    """
    if rules is None:
        rules = CONTRACTS.get(matching_contract(table) or "", {})
    checks = compile_checks(table, df.schema, rules, GLOBAL_RULES if global_rules is None else global_rules)
    counted = [one_pass(df, table, checks)] if any(c.kind in ONE_PASS for c in checks) else []
    return _report(df, table, checks, counted)


def _report(df: DataFrame, table: str, checks: Sequence[Check], parts: list[DataFrame]) -> DataFrame:
    """``parts``, the lines of the counted checks, and those that group the table."""
    grouped = [c for c in checks if c.kind in ("unique", "pairs")]
    if grouped:
        parts.append(uniqueness(df, table, grouped))
    for check in (c for c in checks if c.kind == "positions"):
        bad = position_gaps(df, *check.column.split(",")).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(bad.select(F.inline(F.array(_line(table, check, F.col("_n"), F.lit(0))))))
    return reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], REPORT_SCHEMA)


def violation_samples(df: DataFrame, table: str, checks: Sequence[Check], row_id: str, n: int | None = 5) -> DataFrame:
    """A sample for a report: up to ``n`` offending values per check (all for None), long ones shortened, from one scan.

    They come in the order of ``row_id``, which is unique; pruning to the first n runs before the shuffle.
    """
    cells = [F.when(c.bad, F.struct(F.lit(c.rule).alias("rule"), F.lit(c.column).alias("column_name"),
                                    F.col(c.column).cast("string").alias("value")))
             for c in checks if c.kind == "rows" and c.rule != "not_null"]
    broken = df.select(F.col(row_id).cast("string").alias("row_id"),
                       F.explode(F.filter(F.array(*cells), lambda x: x.isNotNull())).alias("_v"))
    rows = broken.select("row_id", "_v.*")
    rank = F.row_number().over(Window.partitionBy("rule", "column_name").orderBy("row_id"))
    ranked = rows.withColumn("n", rank)
    return ((ranked if n is None else ranked.where(F.col("n") <= n))
            .select(F.lit(table).alias("table_name"), "rule", "column_name", "row_id",
                    shorten("value").alias("value"), "n"))


@dataclass
class SuiteReport:
    """Lines of every table, the tables without a contract and the patterns no table used."""

    lines: DataFrame
    without_rules: list[str] = field(default_factory=list)
    unused_patterns: list[str] = field(default_factory=list)

    def failures(self) -> DataFrame:
        return self.lines.where((F.col("severity") == FAIL) & ~F.col("passed"))

    def per_table(self) -> DataFrame:
        bad = ~F.col("passed")
        return self.lines.groupBy("table_name").agg(
            F.count_if(bad & (F.col("severity") == FAIL)).alias("n_failed"),
            F.count_if(bad & (F.col("severity") != FAIL)).alias("n_warned"),
            F.count(F.lit(1)).alias("n_checks"))

    def passed(self) -> bool:
        return self.failures().isEmpty()


@dataclass
class WrittenChecks:
    """Checks of tables as they are written: give ``watch`` to ``Outputs``, and ask for the ``report`` when the run is over.

    Counted rules are observed in the stage that writes a table, so they read nothing; uniqueness and positions group the stored
    rows. No plan that built a table runs again.
    """

    contracts: Mapping[str, Any] = field(default_factory=lambda: CONTRACTS)
    global_rules: Mapping[str, Any] = field(default_factory=lambda: GLOBAL_RULES)
    seen: dict[str, tuple[list[Check], Observation]] = field(default_factory=dict)

    def watch(self, name: str, df: DataFrame) -> DataFrame:
        rules = self.contracts.get(matching_contract(name, self.contracts) or "", {})
        checks = compile_checks(name, df.schema, rules, self.global_rules)
        self.seen[name] = checks, Observation()
        return df.observe(self.seen[name][1], *_measures(checks))

    def report(self, tables: Mapping[str, DataFrame], prefixes: Iterable[str] = ()) -> SuiteReport:
        """The report of ``run_suite`` on the stored ``tables``; those that were not watched are read for all their checks."""
        names = select_tables(tables, prefixes)
        found = {name: matching_contract(name, self.contracts) for name in names}
        lines = []
        for name in names:
            if name not in self.seen:
                lines.append(evaluate(tables[name], name, self.contracts.get(found[name], {}) if found[name] else {}, self.global_rules))
                continue
            checks, observed = self.seen[name]
            values = observed.get
            row = tables[name].sparkSession.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in values.items()])
            lines.append(_report(tables[name], name, checks, [_lines(row, name, checks)] if any(c.kind in ONE_PASS for c in checks) else []))
        used = set(found.values())
        return SuiteReport(reduce(DataFrame.unionByName, lines), [n for n, p in found.items() if p is None],
                           sorted(p for p in self.contracts if p not in used))


def run_suite(tables: Mapping[str, DataFrame], contracts: Mapping[str, Any] | None = None,
              global_rules: Mapping[str, Any] | None = None, prefixes: Iterable[str] = ()) -> SuiteReport:
    """Check every table whose name starts with one of ``prefixes`` (all without any) against its first contract.

    Each table is read for its counted rules and again for those that group it, so give stored tables, or use ``WrittenChecks``.
    """
    contracts = CONTRACTS if contracts is None else contracts
    names = select_tables(tables, prefixes)
    found = {name: matching_contract(name, contracts) for name in names}
    lines = [evaluate(tables[name], name, contracts.get(found[name], {}) if found[name] else {}, global_rules)
             for name in names]
    used = set(found.values())
    return SuiteReport(reduce(DataFrame.unionByName, lines), [n for n, p in found.items() if p is None],
                       sorted(p for p in contracts if p not in used))
