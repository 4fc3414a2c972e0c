"""Data-quality checks. Each returns rows (check, actual, expected, passed); the values are shown as text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.frames import literal_rows


class QualityError(ValueError):
    """At least one check failed; the message lists all of them."""


def _verdict(rows: DataFrame) -> DataFrame:
    """Adds ``passed``; an actual value of NULL never passes."""
    return rows.select(
        "check",
        F.col("actual").cast("string").alias("actual"),
        F.col("expected").cast("string").alias("expected"),
        F.coalesce(F.col("actual") == F.col("expected"), F.lit(False)).alias("passed"),
    )


def table_checks(table: DataFrame, checks: dict[str, tuple[Column, int]]) -> DataFrame:
    """Checks that are aggregates over one table, all answered by one pass over it."""
    names = list(checks)
    answers = table.agg(*[expr.cast("bigint").alias(f"c{i}") for i, (expr, _) in enumerate(checks.values())])
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("check"),
                    F.col(f"c{i}").alias("actual"),
                    F.lit(checks[name][1]).cast("bigint").alias("expected"),
                )
                for i, name in enumerate(names)
            ]
        )
    )
    return _verdict(answers.select(rows.alias("r")).select("r.*"))


def stated_checks(spark: SparkSession, checks: list[tuple[str, int, int]]) -> DataFrame:
    """Checks ``(name, actual, expected)`` whose values are known already, as from a write that counted its rows."""
    return _verdict(literal_rows(spark, checks, ["check", "actual", "expected"]))


def sql_checks(spark: SparkSession, checks: list[dict]) -> DataFrame:
    """Checks given as ``{"check_sql": one-value query, "expected_result": value}``."""
    answers = []
    for check in checks:
        answer = spark.sql(check["check_sql"])
        row = answer.select(
            F.lit(check["check_sql"]).alias("check"),
            F.col(f"`{answer.columns[0]}`").alias("actual"),
            F.lit(check["expected_result"]).alias("expected"),
        )
        answers.append(_verdict(row))
    return reduce(DataFrame.unionAll, answers)


def non_empty_ratio() -> Column:
    """1 for a table with rows, NULL for an empty one."""
    return F.try_divide(F.count(F.lit(1)), F.count(F.lit(1)))


def null_count(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def not_null(table: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """No NULL in any of the columns."""
    return table_checks(table, {f"{name}.{c} has no null": (null_count(c), 0) for c in columns})


def unique_key(table: DataFrame, name: str, key: list[str]) -> DataFrame:
    """Number of key values that occur more than once."""
    repeated = table.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return table_checks(repeated, {f"{name} key ({', '.join(key)}) is unique": (F.count(F.lit(1)), 0)})


def references(table: DataFrame, name: str, column: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Number of rows whose key is missing in the dimension; NULL keys refer to nothing.

    Rows are counted per key first, so only distinct keys are compared.
    """
    used = (
        table.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    )
    orphans = used.join(dim.select(F.col(dim_key).alias("_key")).distinct(), "_key", "left_anti")
    return table_checks(
        orphans, {f"{name}.{column} refers to {dim_key}": (F.coalesce(F.sum("n"), F.lit(0)), 0)}
    )


def orphan_rows(table: DataFrame, column: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """(key, rows) of the references that point nowhere."""
    used = table.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(dim.select(F.col(dim_key).alias(column)).distinct(), column, "left_anti")


def table_set(spark: SparkSession, tables: dict[str, DataFrame], expected: list[str]) -> DataFrame:
    """The found tables are exactly the expected ones, none empty, none narrower than two columns."""
    found = set(tables)
    names = [
        (f"{name} is expected", int(name in expected), 1) for name in sorted(found)
    ] + [(f"{name} is found", int(name in found), 1) for name in expected]
    widths = [(f"{name} has two columns", int(len(df.columns) >= 2), 1) for name, df in sorted(tables.items())]
    known = literal_rows(spark, names + widths, ["check", "actual", "expected"])
    # one row is enough to know that a table is not empty
    filled = [
        table_checks(df.limit(1), {f"{name} has rows": (F.count(F.lit(1)), 1)}) for name, df in sorted(tables.items())
    ]
    return reduce(DataFrame.unionAll, filled, _verdict(known))


def require(results: DataFrame) -> None:
    """Raise when a check failed, naming all that did. The input has one row per check."""
    failed = [f"{r['check']}: {r['actual']} instead of {r['expected']}" for r in results.where("NOT passed").collect()]
    if failed:
        raise QualityError("; ".join(failed))
