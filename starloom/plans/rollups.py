"""Aggregates kept beside the facts, so that reports over any range read these and not the facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import dim_join
from starloom.operators.keys import dense_ids
from starloom.sinks.loads import load, read_as, replace_partitions, rows_to_insert, table_exists

# -- arrivals per day and port ---------------------------------------------------

DAILY_BY = ["i94yr", "i94mon"]


def daily_arrivals(fact: DataFrame) -> DataFrame:
    """Arrivals per load month, day and port: no port has more rows than the calendar days, no day more than ports."""
    return fact.groupBy(*DAILY_BY, "arrdate_ts", "i94port").agg(F.count(F.lit(1)).alias("n"))


def keep_daily_arrivals(fact: DataFrame, path: str) -> DataFrame:
    """Replace the months that occur in ``fact`` in the table at ``path``; the others stay. Returns the table.

    ``fact`` holds whole months, as the load that follows it replaced them.
    """
    daily = daily_arrivals(fact)
    replace_partitions(daily, path, DAILY_BY)
    return read_as(daily, path)


def weekdays_of_daily(daily: DataFrame, dates: DataFrame, cities: DataFrame, state: str) -> DataFrame:
    """Arrivals per weekday at the ports of one state, from the kept counts."""
    ports = cities.where(F.col("state_code") == state).select(F.col("city_id").alias("i94port"))
    days = dates.select(F.col("date").alias("arrdate_ts"), "weekday")
    there = dim_join(daily.select("arrdate_ts", "i94port", "n"), ports, ["i94port"], hot_rows=None)
    return (
        dim_join(there, days, ["arrdate_ts"], hot_rows=None)
        .groupBy("weekday")
        .agg(F.sum("n").alias("arrivals"))
        .orderBy("weekday")
    )


# -- distinct songs and artists per user ------------------------------------------

HEARD = {"song_id": "songs_played", "artist_id": "artists_played"}
WORD_BITS = 64  # fixed value: bits of a long


def number_keys(keys: DataFrame, path: str, key: str) -> DataFrame:
    """Table ``(key, number)`` at ``path`` with a number from 1 on for each key of ``keys``, without gaps.

    Keys that have one keep it; new ones go on from the largest. NULL gets none.
    """
    wanted = keys.select(key).where(F.col(key).isNotNull()).distinct()
    start = 1
    if table_exists(wanted.sparkSession, path):
        known = wanted.withColumn("number", F.lit(None).cast("bigint"))
        start = (read_as(known, path).agg(F.max("number")).first()[0] or 0) + 1
        wanted = rows_to_insert(known, path, [key], []).select(key)
    return load(dense_ids(wanted, [key], "number", start).select(key, "number"), path, "append")


def listening(songplays: DataFrame, numbers: dict[str, DataFrame], period: Column) -> DataFrame:
    """``(user_id, period, kind, bucket, words)``: which songs and artists each user heard in a period, as bitmaps.

    ``numbers`` has the numbered keys per column of ``HEARD``; keys without a number do not count. A bitmap
    covers 32768 numbers as words of 64 bits and holds only the words in which a bit is set, so it takes what
    the user heard: 512 words at most, one for a single song. Plays are reduced to distinct keys before they are
    joined, and a bitmap is made of 32768 of them at most, so a hot user or song is never gathered as rows.
    """
    parts = []
    plays = songplays.where(F.col("user_id").isNotNull()).withColumn("period", period)
    for kind in HEARD:
        heard = plays.select("user_id", "period", kind).where(F.col(kind).isNotNull()).distinct()
        numbered = dim_join(heard, numbers[kind].select(kind, "number"), [kind], hot_from=songplays)
        place = numbered.withColumn("place", F.bitmap_bit_position("number"))
        parts.append(
            place.select(
                "user_id",
                "period",
                F.lit(kind).alias("kind"),
                F.bitmap_bucket_number("number").alias("bucket"),
                F.expr(f"cast(place div {WORD_BITS} as int)").alias("word"),
                F.expr(f"shiftleft(1L, cast(place % {WORD_BITS} as int))").alias("bit"),
            )
        )
    by = ["user_id", "period", "kind", "bucket"]
    # one shuffle for both steps; a single long is the state of the first
    words = parts[0].unionByName(parts[1]).repartition(*by).groupBy(*by, "word").agg(F.bit_or("bit").alias("bits"))
    return words.groupBy(*by).agg(F.collect_list(F.struct("word", "bits")).alias("words"))


def keep_listening(songplays: DataFrame, numbers: dict[str, DataFrame], period: Column, path: str) -> DataFrame:
    """Replace the periods that occur in ``songplays`` in the table at ``path``; returns the table."""
    bits = listening(songplays, numbers, period)
    replace_partitions(bits, path, ["period"])
    return read_as(bits, path)


def heard_by_user(kept: DataFrame, users: DataFrame, first, last) -> DataFrame:
    """Exact distinct songs and artists per user over the periods from ``first`` to ``last``; no fact is read.

    Bitmaps are merged by OR, word by word and combined on the map side, then counted.
    """
    merged = (
        kept.where(F.col("period").between(first, last))
        .select("user_id", "kind", "bucket", F.inline("words"))
        .groupBy("user_id", "kind", "bucket", "word")
        .agg(F.bit_or("bits").alias("bits"))
    )
    counts = [
        F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bit_count("bits"))), F.lit(0)).alias(name)
        for kind, name in HEARD.items()
    ]
    heard = merged.groupBy("user_id").agg(*counts)
    named = dim_join(heard, users.select("user_id", "last_name").distinct(), ["user_id"], hot_rows=None)
    return named.select("user_id", "last_name", *HEARD.values()).orderBy(
        *[F.desc(name) for name in HEARD.values()], "user_id", "last_name"
    )
