"""Registration of named queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tellerflow.lake import Lake, lake_for
from tellerflow.queries.oracle import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None):
    """Register ``fn(lake) -> DataFrame`` under a name; without SQL the query is checked by its tests only."""

    def wrap(fn: Callable[[Lake], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(lake_for(spark, folder))
        if sql:
            ORACLES[name] = with_views(sql)
        return fn

    return wrap
