"""Registered queries and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waypost.catalog.standin import portable
from waypost.workspace import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL oracle if it has one."""

    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf: portable(build(use_utc(spark), sf))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
