"""Every query of the library by name, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridloom.plans import crawl_queries, curation_queries, operator_queries, view_queries

Query = Callable[[SparkSession, str], DataFrame]
_MODULES = (view_queries, operator_queries, curation_queries, crawl_queries)


def queries() -> dict[str, Query]:
    return {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
