"""Query-shaped copies of the event log and the point queries they answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.text import strip_quotes
from starloom.operators.dedup import last_per_key
from starloom.schemas import LOOKUP_TABLES
from starloom.sinks.layout import write_clustered, write_lookup


def lookup_rows(events: DataFrame, table: str, order: list[str] | None = None, without_quotes: bool = False) -> DataFrame:
    """Rows of one lookup table: its columns, one row per primary key, the last written wins."""
    spec = LOOKUP_TABLES[table]
    names = spec["columns"].names
    key = [*spec["partition_key"], *spec["clustering"]]
    rows = events.select(*dict.fromkeys([*names, *(order or [])]))
    if without_quotes:
        text = [f.name for f in rows.schema if isinstance(f.dataType, T.StringType) and f.name in names]
        rows = rows.withColumns({c: strip_quotes(F.col(c)) for c in text})
    latest = last_per_key(rows, key, order or [c for c in names if c not in key])
    return latest.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in spec["columns"]])


def build_lookup_tables(
    events: DataFrame, root: str, order: list[str] | None = None, without_quotes: bool = False
) -> None:
    """Write the three tables; ``order`` says which of two rows with one key was written last."""
    for table, spec in LOOKUP_TABLES.items():
        write_lookup(
            lookup_rows(events, table, order, without_quotes),
            f"{root}/{table}",
            spec["partition_key"],
            spec["clustering"],
        )


def find(table: DataFrame, columns: list[str], order: list[str] | None = None, **key) -> DataFrame:
    """``columns`` of the rows whose key columns equal the given values, in clustering order.

    Comparing each key column with a literal is what reaches the Parquet scan.
    """
    for name, value in key.items():
        table = table.where(F.col(name) == F.lit(value))
    if order:
        table = table.orderBy(*order)
    return table.select(*columns)


def play_in_session(spark: SparkSession, root: str, session: int, item: int) -> DataFrame:
    table = spark.read.parquet(f"{root}/songInfo")
    return find(table, ["artist", "song", "length"], sessionId=session, itemInSession=item)


def plays_of_session(spark: SparkSession, root: str, user: int, session: int) -> DataFrame:
    table = spark.read.parquet(f"{root}/sessionInfo")
    return find(
        table, ["artist", "song", "firstName", "lastName"], ["itemInSession"], userId=user, sessionId=session
    )


def listeners_of_song(spark: SparkSession, root: str, song: str) -> DataFrame:
    table = spark.read.parquet(f"{root}/userInfo")
    return find(table, ["song", "firstName", "lastName"], song=song)


# What the lookups filter by; one copy clustered by all of them serves each.
CLUSTERED_BY = ["sessionId", "userId", "song"]


def build_one_copy(events: DataFrame, path: str, order: list[str] | None = None, row_group: int | None = None) -> None:
    """One table in place of three: all columns that some lookup needs, clustered by all lookup keys."""
    names = dict.fromkeys(n for spec in LOOKUP_TABLES.values() for n in spec["columns"].names)
    write_clustered(events.select(*dict.fromkeys([*names, *(order or [])])), path, CLUSTERED_BY, row_group=row_group)


def find_in_copy(
    spark: SparkSession, path: str, table: str, columns: list[str], order: list[str] | None = None, **key
) -> DataFrame:
    """What ``find`` on the lookup table ``table`` gives, from the copy of ``build_one_copy``.

    The filter reaches the scan; only the rows it leaves are reduced to one per primary key of that table.
    """
    rows = find(spark.read.parquet(path), ["*"], **key)
    found = lookup_rows(rows, table, order).select(*columns, *LOOKUP_TABLES[table]["clustering"])
    return found.orderBy(*LOOKUP_TABLES[table]["clustering"]).select(*columns)
