"""Tables without natural partitions that take upserts: rows in buckets of their key, buckets in versions.

A bucket is a partition of a catalog table. An upsert merges the buckets that its keys fall into, writes them to a
folder of their own and then points these partitions at it (``ALTER TABLE … PARTITION … SET LOCATION``). Files that
a reader can see are never changed, so an upsert that is killed loses nothing and may simply be run again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.dedup import last_per_key
from starloom.operators.merge import rows_without_keys
from starloom.session import materialize

BUCKET = "key_bucket"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def create(spark: SparkSession, table: str, schema: T.StructType, root: str, keys: list[str], buckets: int) -> None:
    """Declare a table below ``root`` unless it exists.

    Choose as many buckets as keep one at some hundred MB; an upsert rewrites whole buckets only.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
        f"LOCATION '{root}' TBLPROPERTIES ('keys' = '{','.join(keys)}', 'buckets' = '{buckets}')"
    )


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def _buckets(spark: SparkSession, table: str) -> set[int]:
    return {int(r["partition"].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def read(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).drop(BUCKET)


def _point(spark: SparkSession, table: str, bucket: int, path: str, known: bool) -> None:
    """Show ``path`` as the bucket's rows; one catalog change."""
    if known:
        spark.sql(f"ALTER TABLE {table} PARTITION ({BUCKET} = {bucket}) SET LOCATION '{path}'")
    else:
        spark.sql(f"ALTER TABLE {table} ADD PARTITION ({BUCKET} = {bucket}) LOCATION '{path}'")


def upsert(spark: SparkSession, table: str, batch: DataFrame, order: list[str]) -> list[int]:
    """Last write per key wins; returns the buckets that were written anew.

    Of the batch, the row with the highest ``order`` counts per key; NULL is a key like any other. Only the
    buckets of these keys are read and written, and only their number, at most that of all buckets,
    reaches the driver. The buckets become visible one after the other, each whole. One writer at a time.
    """
    settings = _properties(spark, table)
    keys = settings["keys"].split(",")
    shown = spark.table(table)
    names = [c for c in shown.columns if c != BUCKET]
    typed = batch.select(*[F.col(c).cast(shown.schema[c].dataType).alias(c) for c in names])
    newest = last_per_key(typed, keys, order).withColumn(BUCKET, bucket_of(keys, int(settings["buckets"])))
    newest = materialize(newest, "upsert-batch")
    touched = sorted(r[0] for r in newest.select(BUCKET).distinct().collect())
    if not touched:
        return []
    known = _buckets(spark, table)
    # partition pruning: the other buckets are not listed
    target = shown.where(F.col(BUCKET).isin([b for b in touched if b in known]))
    merged = rows_without_keys(target, newest, keys).unionByName(newest)
    version = f"{_location(spark, table)}/version-{uuid.uuid4().hex}"
    merged.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(version)
    for bucket in touched:
        _point(spark, table, bucket, f"{version}/{BUCKET}={bucket}", bucket in known)
    spark.catalog.refreshTable(table)
    return touched


def shown_folders(spark: SparkSession, table: str) -> dict[int, str]:
    """Bucket → folder that readers see."""
    found = {}
    for bucket in _buckets(spark, table):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({BUCKET} = {bucket})")
        found[bucket] = rows.where("col_name = 'Location'").first()["data_type"]
    return found


def drop_old_versions(spark: SparkSession, table: str) -> int:
    """Delete version folders no bucket is shown from; their number. Run it when no reader uses an older state."""
    root = _location(spark, table)
    used = {folder.rsplit("/", 2)[-2] for folder in shown_folders(spark, table).values()}
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [e.getPath() for e in fs.listStatus(base) if e.getPath().getName().startswith("version-")]
    old = [path for path in old if path.getName() not in used]
    for path in old:
        fs.delete(path, True)
    return len(old)
