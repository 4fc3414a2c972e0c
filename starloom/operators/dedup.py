"""One row per key, by a stated order.

Both functions are plain aggregates: Spark combines rows on the map side, so a
key that owns a third of the table never lands whole in one task, as it would
under a ranking window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    lead = [c for c in order if c not in keys]
    packed = F.struct(*lead, *[c for c in rest if c not in lead])
    return (
        df.groupBy(*keys)
        .agg(pick(packed).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Row with the lowest ``order``; ties fall to the remaining columns, NULL lowest."""
    return _pick(df, keys, order, F.min)


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Row with the highest ``order``; ties fall to the remaining columns."""
    return _pick(df, keys, order, F.max)
