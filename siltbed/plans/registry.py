"""Registry of named queries: a Spark callable (spark, sf_dir) -> DataFrame and, where the
result is SQL-expressible, the DuckDB oracle over the driver's tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def _utc(fn):
    """Flush names, periods and partitions are defined in UTC: pin the session zone first."""
    @functools.wraps(fn)
    def run(spark, sf_dir):
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    return run


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = _utc(fn)
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco
