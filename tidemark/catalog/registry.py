"""Registered queries: key, Spark function and, where SQL can say it, the SQL to compare with."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(prepare(spark), sf_dir)

        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return register
