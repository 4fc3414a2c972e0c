"""Business reports on the two stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import dim_join
from starloom.plans.rollups import weekdays_of_daily


def plays_by_user(
    songplays: DataFrame,
    users: DataFrame,
    songs: DataFrame,
    artists: DataFrame,
    time: DataFrame,
    month: int,
) -> DataFrame:
    """Distinct songs and artists each user played in a month.

    Only distinct counts are reported, so the plays are reduced to distinct
    (user, song, artist) as soon as the month is known; songs and artists only
    have to contain the ids, which makes theirs semi-joins that repeat nothing.
    """
    in_month = time.where(F.col("month") == month).select("start_time").distinct()
    played = dim_join(
        songplays.select("user_id", "song_id", "artist_id", "start_time"),
        in_month,
        ["start_time"],
        "left_semi",
    )
    heard = played.select("user_id", "song_id", "artist_id").distinct()
    heard = dim_join(heard, songs.select("song_id"), ["song_id"], "left_semi", hot_from=songplays)
    heard = dim_join(heard, artists.select("artist_id"), ["artist_id"], "left_semi", hot_from=songplays)
    named = dim_join(heard, users.select("user_id", "last_name").distinct(), ["user_id"], hot_from=songplays)
    return (
        named.groupBy("user_id", "last_name")
        .agg(
            F.countDistinct("song_id").alias("songs_played"),
            F.countDistinct("artist_id").alias("artists_played"),
        )
        .orderBy(F.desc("songs_played"), F.desc("artists_played"), "user_id", "last_name")
    )


# The same report in SQL, for views registered under the table names.
PLAYS_BY_USER_SQL = """
WITH heard AS (
  SELECT DISTINCT user_id, song_id, artist_id
  FROM songplays
  WHERE start_time IN (SELECT start_time FROM time WHERE month = {month})
    AND song_id IN (SELECT song_id FROM songs)
    AND artist_id IN (SELECT artist_id FROM artists)
), names AS (
  SELECT DISTINCT user_id, last_name FROM users
)
SELECT user_id, last_name, count(DISTINCT song_id) AS songs_played, count(DISTINCT artist_id) AS artists_played
FROM heard JOIN names USING (user_id)
GROUP BY ALL
ORDER BY songs_played DESC, artists_played DESC, user_id, last_name
"""


def arrivals_in_state(arrivals: DataFrame, cities: DataFrame, state: str) -> DataFrame:
    """The arrivals at the ports of one state: what reports on it need of stage or fact, before either is distinct."""
    ports = cities.where(F.col("state_code") == state).select(F.col("city_id").alias("i94port"))
    return dim_join(arrivals, ports, ["i94port"], "left_semi")


def arrivals_by_weekday(fact: DataFrame, dates: DataFrame, cities: DataFrame, state: str) -> DataFrame:
    """Arrivals per weekday at the ports of one state.

    The fact is counted per (date, port) before it meets the dimensions: no port
    then has more rows than the calendar has days, and no day more than there are ports.
    """
    daily = fact.groupBy("arrdate_ts", "i94port").agg(F.count(F.lit(1)).alias("n"))
    return weekdays_of_daily(daily, dates, cities, state)


def song_artist_pairs(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Songs with the name of their artist."""
    return dim_join(songs, artists.select("artist_id", "name"), ["artist_id"])
