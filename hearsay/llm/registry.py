"""Queries of this subpackage and their SQL forms, by name."""

from __future__ import annotations

import functools

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        @functools.wraps(run)
        def with_session(spark, sf_dir):
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, sf_dir)

        QUERIES[name] = with_session
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register
