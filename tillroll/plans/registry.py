"""Collects the named queries and their SQL twins."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.session import ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        @functools.wraps(run)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir)

        QUERIES[name] = shipped
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def load() -> None:
    """Import the modules that register queries."""
    from tillroll.plans import baskets, features, vectors, files, learning  # noqa: F401, I001
