"""The named queries and, where SQL can say it, the text that must give the same rows."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from crawlweave.plans.derived import duckdb_text
from crawlweave.session import apply_defaults

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query over a folder of the given tables."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(apply_defaults(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = duckdb_text(sql)
        return fn

    return register
