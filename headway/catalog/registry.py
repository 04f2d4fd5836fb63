"""Registered queries: a Spark function over the views, and SQL for the same result if there is."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from headway.catalog.sql_views import with_views
from headway.catalog.views import Views


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Views], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Views(spark, folder))


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, *views: str):
    """Register a function under its own name. ``sql`` may use the named views."""

    def register(build):
        name = build.__name__
        QUERIES[name] = Query(name, build, with_views(sql, *views) if sql else None)
        return build

    return register
