"""Surrogate keys."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.session import materialize

# Ids that one reservation mark stands for.
ID_BLOCK = 1 << 20
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def dense_ids(df: DataFrame, order: list[str], name: str, start: int = 1) -> DataFrame:
    """Gap-free ids in the total order ``order``, without sorting in one task.

    The rows are range-partitioned and sorted once and written down with their
    position inside their partition. A second pass counts the rows of each
    partition; the running total over those counts (one row per partition) is
    the offset added to each position. Rows that tie on ``order`` are told
    apart by content and source partition, so many equal rows still spread.
    """
    tie = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns])
    ranked = [*order, "_tie"]
    placed = materialize(
        df.withColumn("_tie", tie)
        .repartitionByRange(*ranked)
        .sortWithinPartitions(*ranked)
        .drop("_tie")
        .withColumn("_place", F.monotonically_increasing_id()),
        name,
    )
    part = F.shiftright("_place", _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        placed.withColumn("_part", part)
        # one row per written partition
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_offset") + position + F.lit(start)).alias(name), *df.columns)
    )


def _created(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there. The file system lets one of several callers win."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        if fs.getScheme() == "file":  # Hadoop's local file system looks first and creates then
            jvm.java.nio.file.Files.createFile(jvm.java.io.File(target.toUri().getPath()).toPath(), spark._sc._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0))
        else:
            fs.create(target, False).close()
    except Py4JJavaError as error:
        if "Exist" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def reserve_blocks(spark: SparkSession, folder: str, blocks: int) -> list[int]:
    """Numbers of ``blocks`` id blocks that no other caller gets, on a file system that all writers share.

    A block is taken by creating its mark, which only one can. Blocks of a writer that dies stay taken: ids
    are unique, not gap-free.
    """
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(folder)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(base)
    taken = [int(e.getPath().getName().rsplit("-", 1)[1]) for e in fs.listStatus(base) if e.getPath().getName().startswith("block-")]
    at, got = max(taken, default=-1) + 1, []
    while len(got) < blocks:
        if _created(spark, f"{folder}/block-{at:012d}"):
            got.append(at)
        at += 1
    return got


def reserved_ids(df: DataFrame, order: list[str], name: str, folder: str, start: int = 1, block: int = ID_BLOCK) -> DataFrame:
    """Ids that stay unique when several jobs number rows at once; ascending in ``order`` within this call.

    All jobs name the same ``folder`` and ``block``. One mark is reserved per ``block`` rows.
    """
    spark = df.sparkSession
    placed = materialize(dense_ids(df, order, "_position", 0), name)
    blocks = reserve_blocks(spark, folder, -(-placed.count() // block))
    firsts = spark.createDataFrame([(i, start + b * block) for i, b in enumerate(blocks)], "_nth bigint, _first bigint")
    nth = F.floor(F.col("_position") / block)
    numbered = placed.withColumn("_nth", nth).join(F.broadcast(firsts), "_nth")  # one row per block of ids
    return numbered.select((F.col("_first") + F.col("_position") % block).alias(name), *df.columns)


def gap_ids(df: DataFrame, name: str) -> DataFrame:
    """Unique ids with gaps. The values depend on the plan; write the result once and keep it."""
    return df.withColumn(name, F.monotonically_increasing_id())


def content_key(*parts: Column) -> Column:
    """md5 over the parts as text; NULL in any part gives NULL."""
    return F.md5(F.concat(*[p.cast("string") for p in parts]))
