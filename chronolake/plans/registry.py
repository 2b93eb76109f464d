"""Registration of queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, views: str = "", sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under a name; sql may use the named views."""

    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = fixtures.sql(views, sql)
        return f

    return add
