"""Registry of the checked queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from flowtables.session import split_skew

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query ``(spark, folder) -> DataFrame`` and the SQL that must agree with it.

    A registered query makes sure that its session splits skewed joins.
    """

    def register(function):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        @wraps(function)
        def prepared(spark: SparkSession, folder: str) -> DataFrame:
            split_skew(spark)
            return function(spark, folder)

        QUERIES[name] = prepared
        if sql is not None:
            SQL[name] = sql
        return function

    return register
