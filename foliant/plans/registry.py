"""Registration of named queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliant.plans.views import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a function of Tables under its name; sql is what DuckDB runs for the same rows."""

    def wrap(f: Callable[[Tables], DataFrame]):
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[key] = sql
        return f

    return wrap
