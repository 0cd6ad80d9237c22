"""Registry that pairs each runnable query with its ANSI SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``; ``sql`` is its check, if SQL can say it."""

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from sparkdesk.plans.tables import Tables

            return fn(Tables(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap
