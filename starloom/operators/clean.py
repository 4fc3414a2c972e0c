"""Row and column cleaning shared by the builds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; a value that cannot be read becomes NULL."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def default_for_null(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def not_before(df: DataFrame, columns: list[str], bound: Column) -> DataFrame:
    """Rows whose every listed column reaches the bound; NULL and NaN do not."""
    for column in columns:
        df = df.where(F.col(column) >= bound)
        if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
            df = df.where(~F.isnan(column))
    return df


def matched_only(df: DataFrame, columns: list[str], unmatched: str = "None") -> DataFrame:
    """Rows whose every listed column differs from the word for "no match"; NULL drops out too."""
    for column in columns:
        df = df.where(F.col(column) != unmatched)
    return df


def like_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.where(F.col(column).startswith(prefix))
