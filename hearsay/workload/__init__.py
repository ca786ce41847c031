"""Registered queries over the test tables, each next to its SQL form."""

from __future__ import annotations

import importlib

MODULES = ["scoring", "functions", "projections", "joins", "events", "ranking", "tables", "text", "clusters", "jobs"]


def load():
    """Import all query modules; returns the queries and the SQL forms by name."""
    for name in MODULES:
        importlib.import_module(f"hearsay.workload.{name}")
    from hearsay.workload.registry import ORACLE, QUERIES

    return QUERIES, ORACLE
