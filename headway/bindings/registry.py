"""Named queries over the bound views, each with the SQL giving the expected result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from headway.bindings.views import Bound

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of the bound views; without SQL only its rows are counted."""

    def register(build: Callable[[Bound], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Bound(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return build

    return register
