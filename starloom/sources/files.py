"""Readers for the log, metadata, event and reference files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas
from starloom.functions.text import non_empty
from starloom.operators.dedup import first_per_key
from starloom.operators.frames import conform


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Activity log, one JSON object per line."""
    return spark.read.schema(schemas.ACTIVITY_LOG).json(path)


def read_songs(spark: SparkSession, path: str) -> DataFrame:
    """Song metadata: JSON files at any depth below ``path``."""
    return (
        spark.read.schema(schemas.SONG_METADATA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(path)
    )


def read_csv(spark: SparkSession, path: str, sep: str = ",", schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header; every column a string unless a schema is given. A quote in a value is doubled."""
    reader = spark.read.option("header", True).option("sep", sep).option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def read_event_csvs(spark: SparkSession, path: str) -> DataFrame:
    """All event files below ``path`` as one relation: plays only, the kept columns only."""
    events = read_csv(spark, path, schema=schemas.EVENT_CSV)
    return events.where(non_empty(F.col("artist"))).select(*schemas.EVENT_CSV_KEPT)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): one row per file with its whole text."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), "value"
    )


def first_record_per_file(df: DataFrame) -> DataFrame:
    """The first record of each file, for sources that hold one object per file.

    ``df`` must come straight from a file reader. Position in the file is the
    block start and the row number within the task that read the block.
    """
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return first_per_key(placed, ["_file"], ["_block", "_row"]).select(*df.columns)


def subfolders(spark: SparkSession, root: str) -> dict[str, str]:
    """name → path of the folders directly below ``root``, on any file system Spark can read."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return {
        entry.getPath().getName(): entry.getPath().toString()
        for entry in files.listStatus(folder)
        if entry.isDirectory()
    }


def restore_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every table below ``root`` under its folder name."""
    return {name: spark.read.parquet(path) for name, path in sorted(subfolders(spark, root).items())}


def read_monthly(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Monthly Parquet files whose column sets (or types) differ, brought to one contract.

    Each file is cast to the contract before the union, so a type that changed
    between months does not matter; extra columns are dropped.
    """
    months = [conform(spark.read.parquet(p), schema) for p in paths]
    return reduce(DataFrame.unionByName, months)
