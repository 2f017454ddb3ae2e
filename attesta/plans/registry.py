"""Name → (plan, comparison SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from attesta.tables import Tables

PLANS: dict[str, Callable[[Tables], DataFrame]] = {}
SQL: dict[str, str] = {}


def plan(name: str, sql: str | None = None):
    """Register a plan under ``<id>_<short>``; ``sql`` is left out where SQL cannot state the result."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in PLANS:
            raise ValueError(f"plan {name} registered twice")
        PLANS[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return add


def as_query(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(Tables(spark, sf_dir))
