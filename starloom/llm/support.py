"""Helpers that several operators of this package share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import materialize

# Rows and bytes of one batch that Spark hands to Python: bounds a worker's memory when texts are long.
BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20

FILE, PLACE = "__located_file", "__located_place"


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches small enough for long texts, and workers that find this package; both hold for the session."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p and p != root]
    env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with two more columns that name each row: its file and its place in that file.

    Both stay the same however often and in whatever splits the table is read,
    so rows that agree in every column, or have no id, can still be told apart.
    A frame that is no plain scan of files is first written to the shared folder; one that
    has the two columns stays as it is.
    """
    if {FILE, PLACE} <= set(docs.columns):
        return docs
    try:
        return _with_place(docs)
    except AnalysisException:
        return _with_place(materialize(docs, "located"))


def _with_place(docs: DataFrame) -> DataFrame:
    origin = docs.metadataColumn("_metadata")
    return docs.select("*", origin["file_path"].alias(FILE), origin["row_index"].alias(PLACE))


def keep_located(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``located(docs)`` that ``kept`` names, under the columns of ``docs``."""
    names = [c for c in docs.columns if c not in (FILE, PLACE)]
    return docs.join(kept.select(FILE, PLACE), [FILE, PLACE], "left_semi").select(*names)


def hex_of(number: Column) -> Column:
    """A 64-bit number as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(number), 16, "0"))
