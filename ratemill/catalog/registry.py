"""Named queries over a folder of star tables, each with an equivalent SQL text where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratemill.catalog.star import plain
from ratemill.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its own name; its result columns are cast to plain types."""
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(prepare(spark), sf_dir))
        run.__name__ = fn.__name__
        QUERIES[fn.__name__] = run
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return add
