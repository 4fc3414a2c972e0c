"""Physical layouts: point-lookup tables, declared tables, views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows that the cuts of a clustering key are taken from; they settle the layout only, never a result.
CUT_ROWS = 100_000


def write_lookup(df: DataFrame, path: str, partition_key: list[str], clustering: list[str], mode: str = "overwrite") -> None:
    """Table laid out for lookups by ``partition_key``.

    Rows are range-partitioned and sorted by (partition key, clustering), so
    the min/max values of each file and row group are narrow and a filter on
    the key skips almost all of them. Ranging over the clustering columns too
    lets one large partition key spread over several files.
    """
    order = [*partition_key, *clustering]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).parquet(path)


def cut_points(df: DataFrame, column: str, cuts: int) -> list:
    """At most ``cuts`` ascending values that split a sample of ``column`` into about equal parts; works for any ordered type."""
    rows = df.count()
    sample = df.select(column).where(F.col(column).isNotNull())
    if rows > CUT_ROWS:
        sample = sample.sample(CUT_ROWS / rows, seed=7)
    parts = sample.repartitionByRange(cuts + 1, column).select(column, F.spark_partition_id().alias("_part"))
    lows = parts.groupBy("_part").agg(F.min(column).alias("low")).select("low").distinct()
    return sorted(r["low"] for r in lows.collect())[1:]


def interleaved(places: list[Column], bits: int) -> Column:
    """One number from the bits of several, the highest bits of all first: near in it is near in each."""
    return reduce(
        lambda a, b: a.bitwiseOR(b),
        [
            F.shiftleft(F.shiftright(place, bit).bitwiseAND(1).cast("bigint"), bit * len(places) + i)
            for i, place in enumerate(places)
            for bit in range(bits)
        ],
    )


def write_clustered(
    df: DataFrame, path: str, columns: list[str], bits: int = 4, mode: str = "overwrite", row_group: int | None = None
) -> None:
    """Table laid out for filters on any of ``columns``.

    Each column is cut into 2^bits ranges of about equal rows, and the rows lie in the order of the interleaved bits of
    their range numbers, so every file and row group holds a narrow range of every column. With 2^k row groups
    a filter on one of n columns reads about one in 2^(k/n). ``row_group`` sets their bytes.
    """
    places = []
    for column in columns:
        cuts = cut_points(df, column, (1 << bits) - 1)
        kind = df.schema[column].dataType
        below = [F.when(F.col(column) >= F.lit(c).cast(kind), 1).otherwise(0) for c in cuts]
        places.append(reduce(lambda a, b: a + b, below, F.lit(0)))
    placed = df.withColumn("_cell", interleaved(places, bits))
    placed = placed.repartitionByRange("_cell", *columns).sortWithinPartitions("_cell", *columns).drop("_cell")
    writer = placed.write.mode(mode)
    (writer.option("parquet.block.size", row_group) if row_group else writer).parquet(path)


def write_bucketed(
    df: DataFrame, table: str, path: str, key: list[str], sort: list[str], buckets: int, mode: str = "overwrite"
) -> None:
    """Table bucketed by a join key and sorted inside the buckets.

    Two tables bucketed alike join on that key without a shuffle. For large
    tables that are joined again and again; small ones are broadcast anyway,
    and a key with hot values belongs into ``sliced_join`` instead.
    """
    (
        df.repartition(buckets, *key)
        .write.mode(mode)
        .bucketBy(buckets, *key)
        .sortBy(*sort)
        .option("path", path)
        .format("parquet")
        .saveAsTable(table)
    )


def create_table(spark: SparkSession, table: str, schema: T.StructType, path: str | None = None) -> None:
    """Declare a Parquet table unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{where}")


def create_tables(spark: SparkSession, schemas: dict[str, T.StructType], root: str) -> None:
    """Declare a set of tables, each in its folder below ``root``."""
    for name, schema in schemas.items():
        create_table(spark, name, schema, f"{root}/{name}")


def drop_tables(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        drop_table(spark, name)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
