"""The registered queries of the library, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import assembly, biology, bins, files, networks, panels, reads, recruitment, reporting, results, taxa, upkeep

MODULES = (assembly, networks, reporting, biology, upkeep, reads, taxa, bins, files, panels, recruitment, results)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
