"""Dimensions and fact of the music star.

The same five tables exist under four rule sets, which differ in grain, join
keys, duplicates and ids:

``keyed``      every play is kept, matched by title+artist+duration or not at all
``warehouse``  plays join songs by title, hours as start time
``lake``       as before plus a join to artists that still hold duplicates, seconds
``strict``     only plays matched by title+artist+rounded duration, hashed id
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.timeparts import epoch_ms_to_second, epoch_ms_to_text, epoch_ms_to_ts, time_parts
from starloom.operators.clean import default_for_null
from starloom.operators.dedup import first_per_key
from starloom.operators.joins import HOT_ROWS, dim_join, estimated_bytes
from starloom.operators.keys import content_key

PLAY = "NextSong"  # fixed value: the page of a play

# What a missing location or coordinate is stored as.
ARTIST_DEFAULTS = {"location": "NaN", "latitude": 0.0, "longitude": 0.0}
UNKNOWN_USER = -1  # fixed value


def plays(log: DataFrame, page: str = PLAY) -> DataFrame:
    return log.where(F.col("page") == page)


def typed_log(log: DataFrame) -> DataFrame:
    """Raw log lines with the user id as a number; the empty id of a visitor becomes NULL."""
    return log.withColumns(
        {"userId": F.col("userId").try_cast("int"), "registration": F.col("registration").try_cast("bigint")}
    )


# -- dimensions --------------------------------------------------------------


def users_dim(log: DataFrame, rule: str = "distinct") -> DataFrame:
    """``distinct``: one row per user and level seen. ``first_seen``: the earliest row per user."""
    known = log.where(F.col("userId").isNotNull())
    columns = [
        F.col("userId").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
    ]
    if rule == "distinct":
        return known.select(*columns).distinct()
    if rule == "first_seen":
        return first_per_key(known.select(*columns, "ts"), ["user_id"], ["ts"]).drop("ts")
    raise ValueError(f"users rule <{rule}> is not known")


def songs_dim(songs: DataFrame, rule: str = "distinct") -> DataFrame:
    """``distinct``, ``first`` (one row per song_id) or ``all`` (duplicates kept)."""
    return _by_rule(songs.select("song_id", "title", "artist_id", "year", "duration"), "song_id", rule)


def artists_dim(songs: DataFrame, rule: str = "distinct", defaults: bool = False) -> DataFrame:
    """Artists of the song metadata; ``defaults`` fills missing places."""
    artists = songs.where(F.col("artist_id").isNotNull()).select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        F.col("artist_latitude").alias("latitude"),
        F.col("artist_longitude").alias("longitude"),
    )
    if defaults:
        artists = default_for_null(artists, ARTIST_DEFAULTS)
    return _by_rule(artists, "artist_id", rule)


def _by_rule(df: DataFrame, key: str, rule: str) -> DataFrame:
    if rule == "distinct":
        return df.distinct()
    if rule == "first":
        return first_per_key(df, [key], [c for c in df.columns if c != key])
    if rule == "all":
        return df
    raise ValueError(f"duplicate rule <{rule}> is not known")


def time_dim(stamps: DataFrame, ts: Column, weekday: str = "monday0", distinct: bool = True) -> DataFrame:
    """One row per start time. Distinct runs on the time alone, the parts are computed after it."""
    starts = stamps.select(ts.alias("start_time")).where(F.col("start_time").isNotNull())
    if distinct:
        starts = starts.distinct()
    return starts.select("start_time", *time_parts(F.col("start_time"), weekday))


# -- fact ----------------------------------------------------------------------


def _play_columns(start_time: Column) -> list:
    return [
        start_time.alias("start_time"),
        F.col("userId").alias("user_id"),
        "level",
        "song_id",
        "artist_id",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
    ]


_LOG_USED = ["ts", "userId", "level", "song", "artist", "length", "sessionId", "location", "userAgent"]


def songplays_keyed(
    log: DataFrame, songs: DataFrame, artists: DataFrame, page: str = PLAY, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every play once per (start_time, user_id); song and artist ids NULL when there is no match.

    The catalogue is reduced to one row per (title, artist, duration) first,
    so the join cannot multiply plays.
    """
    played = first_per_key(
        plays(log, page).select(*_LOG_USED), ["ts", "userId"], [c for c in _LOG_USED if c not in ("ts", "userId")]
    )
    catalogue = dim_join(
        songs.select("song_id", "artist_id", F.col("title").alias("song"), F.col("duration").alias("length")),
        artists.select("artist_id", F.col("name").alias("artist")),
        ["artist_id"],
        hot_rows=hot_rows,
    )
    lookup = first_per_key(
        catalogue.select("song", "artist", "length", "song_id", "artist_id"),
        ["song", "artist", "length"],
        ["song_id", "artist_id"],
    )
    # at most one row per song, made of the song's columns and one artist name
    lookup_bytes = 2 * (estimated_bytes(songs) + estimated_bytes(artists))
    matched = dim_join(
        played,
        lookup,
        ["song", "artist", "length"],
        "left",
        hot_rows=hot_rows,
        dim_bytes=lookup_bytes,
        hot_from=plays(log, page),
    )
    return matched.select(*_play_columns(epoch_ms_to_ts(F.col("ts"))))


def songplays_warehouse(log: DataFrame, songs: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Plays joined to songs by title alone, at hour grain: one row per play and same-titled song."""
    titled = songs.select(F.col("title").alias("song"), "song_id", "artist_id")
    matched = dim_join(log.select(*_LOG_USED).where(F.col("song").isNotNull()), titled, ["song"], hot_rows=hot_rows)
    return matched.select(*_play_columns(F.date_trunc("hour", epoch_ms_to_ts(F.col("ts")))))


def songplays_lake(
    log: DataFrame,
    songs: DataFrame,
    artists: DataFrame,
    page: str = PLAY,
    one_per_artist: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Plays joined to songs by title, then to artists by id, at second grain (text).

    ``artists`` may hold an id several times, which repeats the play;
    ``one_per_artist`` reduces it first.
    """
    copies = artists.groupBy("artist_id").agg(F.count(F.lit(1)).alias("_copies"))
    if one_per_artist:
        copies = copies.withColumn("_copies", F.lit(1).cast("bigint"))
    titled = songs.select(F.col("title").alias("song"), "song_id", "artist_id")
    catalogue = dim_join(titled, copies, ["artist_id"], hot_rows=hot_rows)
    # at most one row per song: the song's columns and one number
    catalogue_bytes = 2 * estimated_bytes(titled)
    matched = dim_join(
        plays(log, page).select(*_LOG_USED), catalogue, ["song"], hot_rows=hot_rows, dim_bytes=catalogue_bytes
    )
    # an artist row adds nothing but one more copy of the play
    matched = matched.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
    return matched.select(*_play_columns(epoch_ms_to_text(F.col("ts"))))


def songplays_strict(log: DataFrame, songs: DataFrame, page: str = PLAY, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Plays matched by title, artist name and duration rounded to whole seconds; hashed id.

    The id hashes user and second: two plays of one user within a second share it.
    """
    whole = F.col("length").cast("decimal(18,0)").alias("length")
    played = plays(log, page).where(F.col("ts").isNotNull()).select(
        *[c for c in _LOG_USED if c != "length"], whole
    )
    catalogue = songs.where(F.col("song_id").isNotNull()).select(
        F.col("title").alias("song"),
        F.col("artist_name").alias("artist"),
        F.col("duration").cast("decimal(18,0)").alias("length"),
        "song_id",
        "artist_id",
    )
    matched = dim_join(played, catalogue, ["song", "artist", "length"], hot_rows=hot_rows)
    start, user = epoch_ms_to_second(F.col("ts")), F.coalesce("userId", F.lit(UNKNOWN_USER))
    return matched.withColumn("userId", user).select(
        content_key(F.col("userId"), F.date_format(start, "yyyy-MM-dd HH:mm:ss")).alias("songplay_id"),
        *_play_columns(start),
    )
