"""Staging of JSON text under a mapping, with the rows that fail kept apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REJECTED = "_rejected_text"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as text, one row per line in column ``value``."""
    return spark.read.text(path)


def stage_by_name(lines: DataFrame, text: str, schema: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """Keys go to the columns of the same name; unknown keys are dropped, absent ones are NULL."""
    parsed = lines.select(*(keep or []), F.from_json(text, schema).alias("_row"))
    return parsed.select(*(keep or []), "_row.*")


def stage_by_path(
    lines: DataFrame, text: str, paths: list[str], schema: T.StructType, keep: list[str] | None = None
) -> DataFrame:
    """The n-th JSON path fills the n-th column of ``schema``."""
    if len(paths) != len(schema):
        raise ValueError(f"{len(paths)} paths for {len(schema)} columns")
    mapped = [
        F.get_json_object(text, path).try_cast(field.dataType).alias(field.name)
        for path, field in zip(paths, schema)
    ]
    return lines.select(*(keep or []), *mapped)


def marked(lines: DataFrame, text: str, schema: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """The lines under the schema and, in ``REJECTED``, the text of those that do not fit it (else NULL).

    Good and bad lines are told apart by one parse, so both can be written and counted in one pass.
    """
    keep = keep or []
    checked = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    return lines.select(
        *keep,
        F.from_json(text, checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED}).alias("_row"),
    ).select(*keep, "_row.*")


def split_rejects(
    lines: DataFrame, text: str, schema: T.StructType, keep: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows that fit the schema, and the text of those that do not."""
    parsed = marked(lines, text, schema, keep)
    good = parsed.where(F.col(REJECTED).isNull()).drop(REJECTED)
    bad = parsed.where(F.col(REJECTED).isNotNull()).select(*(keep or []), F.col(REJECTED).alias("text"))
    return good, bad


def stage_with_rejects(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of the JSON lines at ``path``."""
    return split_rejects(read_lines(spark, path), "value", schema)


def of_month(df: DataFrame, ts: str, run_date: str) -> DataFrame:
    """Rows of the calendar month of ``run_date``, as a range that reaches the scan."""
    kind = df.schema[ts].dataType
    first = F.trunc(F.lit(run_date).cast("date"), "month")
    return df.where((F.col(ts) >= first.cast(kind)) & (F.col(ts) < F.add_months(first, 1).cast(kind)))


def month_path(template: str, run_date: str) -> str:
    """Fill ``{year}`` and ``{month}`` of an input path from the run date (``yyyy-MM-dd``)."""
    year, month, _ = run_date.split("-")
    return template.format(year=int(year), month=int(month), run_date=run_date)
