"""Queries of the training-data operators by name, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratemill.llm.common import ready

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ready(spark), sf_dir)
        run.__name__ = fn.__name__
        QUERIES[fn.__name__] = run
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return add
