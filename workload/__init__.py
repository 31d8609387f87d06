"""Queries over the test tables, with the SQL each result is compared to."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from workload import news, search, sensors, storage, streams, texts

Query = Callable[[SparkSession, str], DataFrame]

MODULES = (news, texts, search, sensors, streams, storage)


def in_utc(query: Query) -> Query:
    """The query with timestamps in UTC, whatever the session was started with."""

    @wraps(query)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf)

    return run


def all_queries() -> dict[str, Query]:
    return {name: in_utc(query) for module in MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
