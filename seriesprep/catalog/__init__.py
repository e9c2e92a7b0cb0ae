"""Every operator as a named query over the driver tables, with its SQL counterpart where there is one."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

SECTIONS = (
    "tables", "cleaning", "scalars", "windows", "imputing", "anomalies", "splitting", "labeling",
    "training", "scoring", "profiling", "validating",
)


def _collect() -> tuple[dict[str, Query], dict[str, str]]:
    queries: dict[str, Query] = {}
    sql: dict[str, str] = {}
    for section in SECTIONS:
        registry = import_module(f"seriesprep.catalog.{section}").registry
        clash = set(queries) & set(registry.queries)
        if clash:
            raise ValueError(f"queries registered twice: {sorted(clash)}")
        queries |= registry.queries
        sql |= registry.sql
    return queries, sql


def queries() -> dict[str, Query]:
    return _collect()[0]


def oracle_sql() -> dict[str, str]:
    return _collect()[1]
