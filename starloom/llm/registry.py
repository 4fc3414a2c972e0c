"""Registry of this package's queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.session import pin_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, folder) → DataFrame under its own name."""

    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(pin_utc(spark), folder)

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLE[build.__name__] = sql
        return run

    return register
