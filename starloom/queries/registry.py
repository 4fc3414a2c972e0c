"""Registry of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from starloom.session import pin_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    """Register a function (spark, folder) → DataFrame under its name, without a leading ``run_``."""

    def register(build):
        name = build.__name__.removeprefix("run_")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(pin_utc(spark), folder)

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Whole numbers that may be NULL, as text, so that both sides show them alike."""
    return df.withColumns({c: df[c].cast("string") for c in columns})


def plain(ts: Column) -> Column:
    """Timestamp without zone, as the given tables hold it."""
    return ts.cast("timestamp_ntz")
