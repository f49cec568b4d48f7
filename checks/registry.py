"""Where queries and their oracle SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ASOF = "2024-01-31 00:00:00"


def asof() -> Column:
    return F.lit(ASOF).cast("timestamp")


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can tell the answer on whole tables, its oracle."""
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register
