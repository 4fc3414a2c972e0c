"""Equi-joins that keep working when one key holds a large share of the rows."""

from __future__ import annotations

import math
import sys
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when Catalyst estimates it below this many bytes.
BROADCAST_BYTES = 10 << 20
# A key with more rows than this on the left is cut into slices of about this many rows.
HOT_ROWS = 1_000_000
# Keys to cut, largest first: a few MB at most. A key beyond it owns less than one row in
# HOT_KEYS and is joined whole, so the result never depends on the number.
HOT_KEYS = 100_000
# Codes as numbers, whether they come as text, whole numbers or doubles.
CODE_TYPE = "decimal(38,6)"
# Left rows without a key match nothing; they are only spread over the tasks.
NULL_SLICES = 4096


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate, the one Spark itself plans broadcasts with."""
    plan = getattr(df, "_jdf", None)
    if plan is None:  # a remote session does not tell; take it as large
        return sys.maxsize
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def dim_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int | None = HOT_ROWS,
    dim_bytes: int | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Join on equal column names: broadcast a checked small side, else slice the hot keys.

    Catalyst takes the product of both sides as the size of a join. A caller
    that knows a closer bound for a joined ``dim`` passes it as ``dim_bytes``.
    ``hot_rows=None`` states that ``fact`` holds no hot key, because it was
    reduced to distinct rows before; Spark then picks the join alone.
    """
    if (estimated_bytes(dim) if dim_bytes is None else dim_bytes) <= broadcast_bytes:
        return fact.join(F.broadcast(dim), on, how)
    if hot_rows is None:
        return fact.join(_each_key_once(dim, on, how), on, how)
    return sliced_join(fact, dim, on, how, hot_rows, hot_from)


def _each_key_once(right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Joins that only ask whether a key exists need it once, however often it occurs."""
    return right.select(*on).distinct() if how in ("left_semi", "left_anti") else right


def hot_keys(df: DataFrame, on: list[str], hot_rows: int) -> dict[tuple, int]:
    """Number of slices for each key above ``hot_rows`` rows.

    The rows per key are counted with a map-side combined aggregate; at most
    ``HOT_KEYS`` counts reach the driver.
    """
    counts = _keyed(df, on).groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    hottest = counts.orderBy(F.col("_rows").desc(), *on).limit(HOT_KEYS)
    return {tuple(_same_nan(row[c]) for c in on): -(-row["_rows"] // hot_rows) for row in hottest.collect()}


def _keyed(df: DataFrame, on: list[str]) -> DataFrame:
    """Rows that can match: no key column is NULL. NaN stays, it equals itself in a join."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on]))


def _same_nan(value):
    """One NaN object for all, so that NaN is one dictionary key."""
    return math.nan if isinstance(value, float) and math.isnan(value) else value


def sliced_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Shuffle join in which a hot key is cut into slices of about ``hot_rows`` rows.

    The keys are counted in one pass over each side; ``hot_from`` replaces
    ``left`` there where the caller has the same keys at hand more cheaply. A
    row of a hot key picks its slice from its content and the partition it is
    read from: a rerun task puts it in the same place, and equal rows from
    different partitions still spread. The matching rows of the other side are
    repeated once per slice. Right rows are cut in inner joins only; the other
    forms, which keep left rows, need them once per key.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type <{how}> would repeat right rows")
    right = _each_key_once(right, on, how)
    lefts = hot_keys(left if hot_from is None else hot_from, on, hot_rows)
    rights = hot_keys(right, on, hot_rows) if how == "inner" else {}
    hot = lefts.keys() | rights.keys()
    drops_keyless = how in ("inner", "left_semi")
    if drops_keyless and not hot:
        return left.join(right, on, how)
    if drops_keyless:
        left, right = _keyed(left, on), _keyed(right, on)
    one = F.lit(1).cast("bigint")
    if hot:
        schema = T.StructType([left.schema[c] for c in on]).add("_lefts", T.LongType()).add("_rights", T.LongType())
        cuts = left.sparkSession.createDataFrame([(*k, lefts.get(k, 1), rights.get(k, 1)) for k in hot], schema)
        # HOT_KEYS rows per side at most
        left, right = (side.join(F.broadcast(cuts), on, "left") for side in (left, right))
    else:
        none = F.lit(None).cast("bigint")
        left, right = (side.withColumns({"_lefts": none, "_rights": none}) for side in (left, right))
    keyless = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    lefts_here = F.coalesce("_lefts", F.when(keyless, F.lit(NULL_SLICES).cast("bigint")), one)
    left = _placed(left, "_left", lefts_here, "_right", F.coalesce("_rights", one))
    right = _placed(right, "_right", F.coalesce("_rights", one), "_left", F.coalesce("_lefts", one))
    return left.join(right, [*on, "_left", "_right"], how).drop("_left", "_right")


def _placed(side: DataFrame, own: str, own_slices: Column, other: str, other_slices: Column) -> DataFrame:
    """Each row in one slice of its own side, repeated for every slice of the other side."""
    zero = F.lit(0).cast("bigint")
    row_hash = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in side.columns])
    return (
        side.withColumn(own, F.when(own_slices > 1, F.pmod(row_hash, own_slices)).otherwise(zero))
        .withColumn(other, F.explode(F.sequence(zero, other_slices - 1)))
        .drop("_lefts", "_rights")
    )


def _code_key(df: DataFrame, column: str, side: str) -> DataFrame:
    """``df`` with its code as a 64-bit key.

    A whole number is its own key, which keeps the join on one long. The few other numbers have a hash as key
    and, in ``_odd``, their exact value; text and NaN that are no number get no key.
    """
    kind, value = df.schema[column].dataType, F.col(column)
    exact = value.try_cast(CODE_TYPE)
    if isinstance(kind, T.IntegralType):
        whole = value.cast("bigint")
    elif isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        whole = F.when((value == F.floor(value)) & (F.abs(value) < 2.0**53), value.cast("bigint"))
    else:
        # not evaluated for text that is a plain whole number
        rounded = F.when(exact == F.floor(exact), exact.try_cast("bigint"))
        whole = F.coalesce(F.trim(value).try_cast("bigint"), rounded) if isinstance(kind, T.StringType) else rounded
    df = df.withColumn("_code", whole)
    odd = F.when(F.col("_code").isNull(), exact)
    return df.withColumn(f"_odd_{side}", odd).withColumn(
        "_code", F.coalesce("_code", F.when(F.col(f"_odd_{side}").isNotNull(), F.xxhash64(f"_odd_{side}")))
    )


def code_join(fact: DataFrame, codes: DataFrame, fact_key: str, code_key: str) -> DataFrame:
    """Inner join of a fact to a code list; both keys are compared as numbers.

    Covers a numeric fact key against a text code key (``582.0`` and ``'582'``).
    Codes are exact to six decimals, so long codes do not collide and NaN is no code; 582.5 is a code of its own.
    Rows whose code is NULL, no number or unknown drop out.
    """
    numbered = _code_key(codes, code_key, "right").drop(code_key)
    joined = dim_join(_code_key(fact, fact_key, "left"), numbered, ["_code"])
    # two odd numbers, or an odd and a whole one, may share a key
    both_whole = F.col("_odd_left").isNull().cast("int") + F.col("_odd_right").isNull().cast("int") == 2
    return joined.where(both_whole | (F.col("_odd_left") == F.col("_odd_right"))).drop("_code", "_odd_left", "_odd_right")


def label_join(fact: DataFrame, codes: dict[int, str], fact_key: str, label: str) -> DataFrame:
    """``code_join`` with a code list written in code: an expression instead of a join."""
    number = F.col(fact_key).try_cast("double")
    text = F.lit(None).cast("string")
    for code, name in codes.items():
        text = F.when(number == code, F.lit(name)).otherwise(text)
    return fact.withColumn(label, text).where(F.col(label).isNotNull())


def role_join(fact: DataFrame, lookup: DataFrame, roles: dict[str, str], key: str, label: str) -> DataFrame:
    """Join one lookup once per role: ``roles`` maps a fact key to the label column it yields."""
    for fact_key, out in roles.items():
        fact = code_join(fact, lookup.select(key, F.col(label).alias(out)), fact_key, key)
    return fact


def name_join(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Inner join on names that differ only in case."""
    keyed = left.withColumn("_name", F.lower(left_name))
    return dim_join(keyed, right.withColumn("_name", F.lower(right_name)), ["_name"]).drop("_name")
