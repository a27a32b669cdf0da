"""Registry of queries, and the relations they read.

A fixture describes a relation once, as SQL expressions both engines understand; the Spark side selects them from
the parquet table, the SQL side from the view of the same name.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from rosterlift import RunContext, configure

CTX = RunContext(client="acme", agency_id="agency-1", master_id="master-0", domain="corp.example.com",
                 run_ts=datetime(2024, 6, 30, 12, 0, 0))
NOW = CTX.now_iso


@dataclass(frozen=True)
class Fixture:
    table: str
    columns: Mapping[str, str | tuple[str, str]]  # one expression, or (Spark SQL, DuckDB) where the engines differ
    where: str | None = None

    def frame(self, base: DataFrame) -> DataFrame:
        df = base.where(self.where) if self.where else base
        return df.selectExpr(*[f"{e if isinstance(e, str) else e[0]} AS {n}" for n, e in self.columns.items()])

    def sql(self) -> str:
        cells = ", ".join(f"{e if isinstance(e, str) else e[1]} AS {n}" for n, e in self.columns.items())
        return f"(SELECT {cells} FROM {self.table}{f' WHERE {self.where}' if self.where else ''})"


FIXTURES: dict[str, Fixture] = {}


def src(name: str) -> str:
    """The fixture as a parenthesised SELECT for the SQL side."""
    return FIXTURES[name].sql()


@dataclass
class Tables:
    """Raw tables and fixtures by attribute: ``t.orders``, ``t.contacts``."""

    spark: SparkSession
    folder: str
    _seen: dict[str, DataFrame] = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._seen:
            if name in FIXTURES:
                fixture = FIXTURES[name]
                self._seen[name] = fixture.frame(getattr(self, fixture.table))
            else:
                self._seen[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._seen[name]


Run = Callable[[Tables], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.run(Tables(configure(spark), folder))


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = Query(run, sql)
        return run
    return register


def text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def uuid_sql(*parts: str, client: str = CTX.client) -> str:
    """The id rule in SQL both engines read; every part an SQL expression, the client put in front."""
    digest = f"md5('{client}' || {' || '.join(text(p) for p in parts)})"
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return "(" + " || '-' || ".join(f"substring({digest}, {a}, {n})" for a, n in cuts) + ")"


def id_sql(*parts: str) -> str:
    """Record ids that put the client in front of the key once more."""
    return uuid_sql(f"'{CTX.client}'", *parts)
