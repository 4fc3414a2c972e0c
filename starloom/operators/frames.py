"""Whole-table operators: unions, profiles, pivots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, by name; absent ones NULL, unreadable values NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def outer_union(*frames: DataFrame) -> DataFrame:
    """Union by name that keeps every column of every input; missing ones become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of two relations of equal shape."""
    return left.union(right).distinct()


def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls, percent) for every column, from one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    return counts.unpivot("_rows", list(df.columns), "column", "nulls").select(
        "column",
        "nulls",
        F.round(F.try_divide(F.col("nulls") * 100.0, F.col("_rows")), 2).alias("percent"),
    )


def duplicate_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts, most frequent first."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where("count > 1")
    return counts.orderBy(F.desc("count"), *keys)


def table_shape(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows, cols), one row per table."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).cast("bigint").alias("cols")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, rows)


def literal_rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """Table written in code, as a plan of literals: Catalyst knows how small it is."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def literal_table(spark: SparkSession, codes: dict[int, str], key: str, label: str) -> DataFrame:
    """Small lookup table from a mapping written in code."""
    return literal_rows(spark, list(codes.items()), [key, label])


def pivot_sum(
    df: DataFrame, keys: list[str], pivot: str, value: str, pivot_values: list[str] | None = None
) -> DataFrame:
    """One column per pivot value holding the summed ``value``.

    With ``pivot_values`` given Spark needs no extra pass to learn the columns.
    """
    grouped = df.groupBy(*keys)
    spread = grouped.pivot(pivot, pivot_values) if pivot_values else grouped.pivot(pivot)
    return spread.agg(F.sum(value))


def pivot_map(df: DataFrame, keys: list[str], pivot: str, value: str, name: str = "sums") -> DataFrame:
    """The sums of ``pivot_sum`` as one map per row, keyed by the pivot value as text.

    Needs no list of the values: none passes the driver, and there may be any number of them. A pivot value
    of NULL has the key ``null``, as its column would; pairs without a sum are left out.
    """
    sums = df.groupBy(*keys, F.coalesce(F.col(pivot).cast("string"), F.lit("null")).alias("_key"))
    sums = sums.agg(F.sum(value).alias("_sum")).where(F.col("_sum").isNotNull())
    entries = F.array_sort(F.collect_list(F.struct("_key", "_sum")))
    return sums.groupBy(*keys).agg(F.map_from_entries(entries).alias(name))


def sum_numeric(df: DataFrame, keys: list[str]) -> DataFrame:
    """Roll up to ``keys``: the sum of every other numeric column, under its own name."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in keys]
    return df.groupBy(*keys).agg(*[F.sum(F.col(f"`{c}`")).alias(c) for c in numeric])


def top_n(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first ``n`` rows in ``order``; Spark keeps ``n`` rows per task, no full sort."""
    return df.orderBy(*order).limit(n)
