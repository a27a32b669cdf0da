"""Mapping configurations: how each vendor's export feeds the builders.

``tables(read, ctx, out)`` of a vendor adds its canonical tables to ``out`` by name; ``read`` gives a source table by
name (a ``TableReader``, or any function of that shape).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame

from ..context import RunContext
from ..sources.sinks import Outputs
from . import (bondadapt, bullhorn, ezekia, filefinder, invenias, jobadder, loxo, loxo_csv, manatal, recruit_crm,
               recruitly, seven20, vincere)

VENDORS: dict[str, Callable[..., None]] = {
    module.__name__.rsplit(".", 1)[1]: module.tables for module in (
        bondadapt, bullhorn, ezekia, filefinder, invenias, jobadder, loxo, loxo_csv, manatal, recruit_crm, recruitly,
        seven20, vincere)}


def migrate(vendor: str, read: Callable[[str], DataFrame], ctx: RunContext, folder: str | None = None,
            watch: Callable[[str, DataFrame], DataFrame] | None = None, **options: Any) -> dict[str, DataFrame]:
    """Every canonical table a vendor's export gives; stored as ``folder/<table>`` when a folder is given.

    ``watch`` sees each table as it is written, for example that of ``WrittenChecks``.
    """
    out = Outputs(folder, watch=watch)
    VENDORS[vendor](read, ctx, out, **options)
    return out.tables
