"""Constants of one migration run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from .functions._cols import ColumnLike
from .functions.ids import uuid_from


@dataclass(frozen=True)
class RunContext:
    """What a run knows besides its data; every value enters a plan as a literal.

    ``run_ts`` replaces the wall clock, so re-running a job (or one lost task) gives the same rows.
    ``id_prefix`` is the text in front of a record's key in its id: the client's name once more unless given.
    """

    client: str
    agency_id: str
    master_id: str
    domain: str = ""
    run_ts: datetime = field(default_factory=lambda: datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0))
    filters: Mapping[str, Sequence[str]] = field(default_factory=dict)
    id_prefix: str | None = None

    @property
    def now_iso(self) -> str:
        return self.run_ts.strftime("%Y-%m-%dT%H:%M:%S")

    @property
    def today(self) -> str:
        return self.run_ts.strftime("%Y-%m-%d")

    @property
    def midnight_iso(self) -> str:
        return f"{self.today}T00:00:00"

    def now(self) -> Column:
        return F.to_timestamp(F.lit(self.now_iso), "yyyy-MM-dd'T'HH:mm:ss")

    def record_id(self, *parts: ColumnLike) -> Column:
        prefix = self.client if self.id_prefix is None else self.id_prefix
        return uuid_from(self.client, F.lit(prefix), *parts)

    def master(self) -> Column:
        return F.lit(self.master_id)

    def agency(self) -> Column:
        return F.lit(self.agency_id)
