"""Load modes on Parquet tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.text import clean_headers
from starloom.operators.merge import absent_rows, rows_with_keys, upserted
from starloom.session import materialize
from starloom.sources.files import subfolders

# Partitions of one batch that are named one by one in the filter on the target.
LITERAL_PARTITIONS = 500
# Stretches of a batch's sorted keys that become a filter on a sorted target.
KEY_RANGES = 64

LOAD_MODES = ("append", "overwrite", "errorifexists")


def table_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def load(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None) -> DataFrame:
    """Write a table and return it as read back. ``overwrite`` replaces all, ``append`` adds without looking.

    Rows are brought together by partition value first, so each partition gets
    few files instead of one per task. The split is by rebalance: a partition
    that holds most of the rows is cut over several tasks.
    """
    if mode not in LOAD_MODES:
        raise ValueError(f"load mode <{mode}> is not one of {LOAD_MODES}")
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode).option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return read_as(df, path)


def load_query(
    spark: SparkSession,
    select: str,
    path: str,
    schema: T.StructType,
    mode: str = "append",
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Load what a SELECT over registered views returns; its columns fill the table's by position."""
    rows = spark.sql(select)
    if len(rows.columns) != len(schema):
        raise ValueError(f"{len(rows.columns)} selected columns for {len(schema)} in the table")
    named = rows.toDF(*schema.names)
    return load(named.select(*[F.col(f.name).cast(f.dataType) for f in schema]), path, mode, partition_by)


def read_as(df: DataFrame, path: str) -> DataFrame:
    """The table at ``path`` under the columns of ``df``; works for a table without rows, too."""
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions that occur in ``df``; the other ones stay."""
    (
        df.hint("rebalance", *[F.col(c) for c in partition_by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def _touched(target: DataFrame, batch: DataFrame, partition_by: list[str]) -> DataFrame:
    """The part of ``target`` that lies in the partitions of ``batch``.

    A few partition values become literals, which prune the folders before
    the scan is planned; more of them become a semi-join. Either way NULL equals
    NULL, so the number only decides the plan.
    """
    parts = batch.select(*partition_by).distinct()
    few = parts.limit(LITERAL_PARTITIONS + 1).collect()
    if len(few) > LITERAL_PARTITIONS:
        return rows_with_keys(target, parts, partition_by)
    wanted = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(part[c]) for c in partition_by]) for part in few]
    return target.where(reduce(lambda a, b: a | b, wanted, F.lit(False)))


def load_sorted(
    df: DataFrame, path: str, keys: list[str], mode: str = "errorifexists", partition_by: list[str] | None = None
) -> DataFrame:
    """Write a table whose files hold narrow, sorted ranges of the key, so that ``in_key_ranges`` can skip most of them.

    Equal keys may be cut over several files, so a hot one does not make a large file.
    """
    if mode not in LOAD_MODES:
        raise ValueError(f"load mode <{mode}> is not one of {LOAD_MODES}")
    spread = F.xxhash64(*df.columns)
    placed = df.repartitionByRange(*keys, spread).sortWithinPartitions(*(partition_by or []), *keys)
    writer = placed.write.mode(mode).option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return read_as(df, path)


def in_key_ranges(target: DataFrame, batch: DataFrame, key: str, ranges: int = KEY_RANGES) -> DataFrame:
    """The rows of ``target`` whose ``key`` lies between two neighbouring keys of ``batch``; no row of its keys is lost.

    The batch is cut into at most ``ranges`` stretches of its sorted keys. Their ends become a filter
    that reaches the scan, where it skips the files and row groups outside all stretches.
    """
    parts = batch.select(key).distinct().repartitionByRange(ranges, key).select(key, F.spark_partition_id().alias("_part"))
    ends = parts.groupBy("_part").agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count_if(F.col(key).isNull()).alias("gaps"))
    wanted = F.lit(False)
    for low, high, gaps in ends.select("low", "high", "gaps").collect():
        if gaps:
            wanted = wanted | F.col(key).isNull()
        if low is not None:
            kind = target.schema[key].dataType
            wanted = wanted | F.col(key).between(F.lit(low).cast(kind), F.lit(high).cast(kind))
    return target.where(wanted)


def insert_sorted(
    batch: DataFrame, path: str, keys: list[str], order: list[str], partition_by: list[str] | None = None
) -> None:
    """Insert if absent into a table of ``load_sorted``, whose partition columns need not be part of the key.

    The rows read from the table fall with the batch: only key ranges that the batch has keys in.
    """
    if table_exists(batch.sparkSession, path):
        target = in_key_ranges(read_as(batch, path), batch, keys[0])
        new = absent_rows(target, batch, keys, order)
    else:
        new = absent_rows(batch.limit(0), batch, keys, order)
    load_sorted(new, path, keys, "append", partition_by)


def rows_to_insert(
    batch: DataFrame, path: str, keys: list[str], order: list[str], partition_by: list[str] | None = None
) -> DataFrame:
    """The first row per key of ``batch`` whose key the table at ``path``, if there is one, does not hold.

    When the partition columns are part of the key, only the table's
    partitions that the batch touches are read.
    """
    if not table_exists(batch.sparkSession, path):
        # the same reduction a present, empty table would lead to
        return absent_rows(batch.limit(0), batch, keys, order)
    target = read_as(batch, path)
    if partition_by and set(partition_by) <= set(keys):
        target = _touched(target, batch, partition_by)
    return absent_rows(target, batch, keys, order)


def insert_if_absent(
    batch: DataFrame, path: str, keys: list[str], order: list[str], partition_by: list[str] | None = None
) -> None:
    """Append the rows whose key the table does not hold; rerunning a batch adds nothing."""
    load(rows_to_insert(batch, path, keys, order, partition_by), path, "append", partition_by)


def upsert(
    batch: DataFrame, path: str, keys: list[str], order: list[str], partition_by: list[str] | None = None
) -> None:
    """Last write per key wins.

    The merged rows are written to the shared folder before the table is
    touched, because a table cannot be overwritten while it is read. When the
    partition columns are part of the key, only the touched partitions are
    merged and replaced.
    """
    spark = batch.sparkSession
    if not table_exists(spark, path):
        load(upserted(batch.limit(0), batch, keys, order), path, partition_by=partition_by)
        return
    target = read_as(batch, path)
    by_part = bool(partition_by) and set(partition_by) <= set(keys)
    if by_part:
        target = _touched(target, batch, partition_by)
    merged = materialize(upserted(target, batch, keys, order), "upsert").select(*batch.columns)
    if by_part:
        replace_partitions(merged, path, partition_by)
    else:
        load(merged, path, "overwrite", partition_by)


def land_raw(tables: dict[str, DataFrame], root: str, mode: str = "errorifexists") -> None:
    """Write every source below ``root``/raw/name with clean column names."""
    for name, df in tables.items():
        load(clean_headers(df), f"{root}/raw/{name}", mode)


def export_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header and every value in quotes; a quote in a value is doubled."""
    df.write.mode(mode).option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def check_table_set(spark: SparkSession, root: str) -> set[str]:
    """Names of the tables found below ``root``."""
    return set(subfolders(spark, root))
