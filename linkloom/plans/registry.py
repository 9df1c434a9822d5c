"""The list of queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkloom.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function (spark, folder) -> DataFrame under its own name."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(prepare(spark), folder)

        run.__name__ = build.__name__
        run.__doc__ = build.__doc__
        QUERIES[build.__name__] = run
        if sql:
            ORACLES[build.__name__] = sql
        return run

    return register
