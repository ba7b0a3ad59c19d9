"""Names of the core queries, each with its callable and, where SQL can express it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leafwright.plans import block_queries, block_sql, nested_queries


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**block_queries.queries(), **nested_queries.queries()}


def core_sql() -> dict[str, str]:
    return {**block_sql.oracle_sql(), **nested_queries.oracle_sql()}
