"""The registered queries of the bibliographic operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliant.plans import join_queries, review_queries, storage_queries, text_queries  # noqa: F401  (they register their queries)
from foliant.plans.registry import QUERIES, SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
