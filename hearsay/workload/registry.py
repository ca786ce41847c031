"""Collects queries and their SQL forms by name."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = "") -> Callable[[Query], Query]:
    """Register a query; ``views`` names the fixture views its SQL form reads."""

    def register(run: Query) -> Query:
        from hearsay.workload import fixtures

        @functools.wraps(run)
        def with_session(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, sf_dir)

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = with_session
        if sql is not None:
            ORACLE[name] = fixtures.sql_views(views.split(), sql)
        return run

    return register
