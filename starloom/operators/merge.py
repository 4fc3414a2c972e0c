"""Relations behind the load modes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.dedup import first_per_key, last_per_key


def _known_keys(rows: DataFrame, known: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Semi- or anti-join of ``rows`` with the keys of ``known``; NULL equals NULL."""
    seen = known.select(*[F.col(k).alias(f"_known_{i}") for i, k in enumerate(keys)]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_known_{i}")) for i, k in enumerate(keys)])
    return rows.join(seen, same, how)


def rows_with_keys(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return _known_keys(rows, known, keys, "left_semi")


def rows_without_keys(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return _known_keys(rows, known, keys, "left_anti")


def absent_rows(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of ``batch`` to insert: the first per key, where ``target`` has no such key yet.

    Both sides of the anti-join hold each key once, so no key is hot in it. NULL
    is a key like any other.
    """
    fresh = first_per_key(batch, keys, order)
    return rows_without_keys(fresh, target, keys).select(*batch.columns)


def upserted(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``target`` after the batch, where the last row written per key wins.

    The batch is reduced to one row per key first and the target is compared
    with its keys only; NULL is a key like any other. Columns missing on either side become NULL.
    """
    newest = last_per_key(batch, keys, order)
    kept = rows_without_keys(target, newest, keys)
    return kept.select(*target.columns).unionByName(newest, allowMissingColumns=True)
