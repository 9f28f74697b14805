"""Register of queries: a Spark function and, where SQL can say it, the statement that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.catalog.sql_views import with_views
from tidemark.catalog.tables import Tables

Body = Callable[[Tables], DataFrame]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, replaced: dict[str, str] | None = None) -> Callable[[Body], Body]:
    """Register a query under a name; ``replaced`` gives views of its SQL another definition."""

    def register(body: Body) -> Body:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return body(Tables(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, replaced)
        return body

    return register
