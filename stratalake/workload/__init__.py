"""Registered queries: each operator on the given tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where there is one, the SQL that must agree with it."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    from stratalake.workload import (  # noqa: F401
        checks, comparisons, concepts, fda, ingest, keys, rejects, reports, serving, shaping, store, versions,
    )
