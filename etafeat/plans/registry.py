"""Registry of named queries over the test tables, each with a DuckDB twin.

A query is ``fn(spark, sf_dir) -> DataFrame``; its twin is ANSI SQL over views
named like the tables. Column names and types agree between the two.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    covers: str


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None, covers: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, covers)
        return fn
    return deco
