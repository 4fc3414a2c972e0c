"""Music star on events (log) and part (songs)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from starloom.functions.timeparts import epoch_ms_to_ts
from starloom.operators.keys import dense_ids, gap_ids, reserved_ids
from starloom.plans import music, reports, rollups
from starloom.queries.inputs import LOG_SQL, META_SQL, PLAY, activity_log, song_metadata
from starloom.queries.registry import as_text, plain, query, table
from starloom.session import scratch_path
from starloom.sinks.loads import load

BASE = f"WITH {LOG_SQL},\n{META_SQL}\n"
STAMP = "make_timestamp(ts * 1000)"
PARTS = """CAST(hour(t) AS INTEGER) AS hour, CAST(day(t) AS INTEGER) AS day,
CAST(week(t) AS INTEGER) AS week, CAST(month(t) AS INTEGER) AS month, CAST(year(t) AS INTEGER) AS year"""


# -- dimensions --------------------------------------------------------------


@query(
    f"""WITH {LOG_SQL} SELECT DISTINCT userId AS user_id, firstName AS first_name, lastName AS last_name,
gender, level FROM log WHERE page = 'purchase' AND userId IS NOT NULL"""
)
def users_dim_distinct(spark, folder):
    return music.users_dim(music.plays(activity_log(spark, folder), PLAY))


@query(
    f"""WITH {LOG_SQL} SELECT DISTINCT userId AS user_id, firstName AS first_name, lastName AS last_name,
gender, level FROM log WHERE userId IS NOT NULL"""
)
def users_dim_all_pages(spark, folder):
    return music.users_dim(activity_log(spark, folder))


@query(
    f"""WITH {LOG_SQL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY userId
ORDER BY ts, firstName, lastName, gender, level) AS rn FROM log WHERE page = 'purchase' AND userId IS NOT NULL)
SELECT userId AS user_id, firstName AS first_name, lastName AS last_name, gender, level FROM ranked WHERE rn = 1"""
)
def users_dim_first_seen(spark, folder):
    return music.users_dim(music.plays(activity_log(spark, folder), PLAY), "first_seen")


@query(f"WITH {META_SQL} SELECT DISTINCT song_id, title, artist_id, year, duration FROM meta")
def songs_dim(spark, folder):
    return music.songs_dim(song_metadata(spark, folder))


@query(
    f"""WITH {META_SQL} SELECT DISTINCT artist_id, artist_name AS name,
coalesce(artist_location, 'NaN') AS location, coalesce(artist_latitude, 0.0) AS latitude,
coalesce(artist_longitude, 0.0) AS longitude FROM meta WHERE artist_id IS NOT NULL"""
)
def artists_dim_defaults(spark, folder):
    return music.artists_dim(song_metadata(spark, folder), defaults=True)


@query(
    f"""WITH {META_SQL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY artist_id
ORDER BY artist_name NULLS FIRST, artist_location NULLS FIRST, artist_latitude NULLS FIRST,
artist_longitude NULLS FIRST) AS rn FROM meta)
SELECT artist_id, artist_name AS name, artist_location AS location, artist_latitude AS latitude,
artist_longitude AS longitude FROM ranked WHERE rn = 1"""
)
def artists_dim_one_per_key(spark, folder):
    return music.artists_dim(song_metadata(spark, folder), "first")


def _time(frame):
    return frame.withColumn("start_time", plain(F.col("start_time")))


@query(
    f"""WITH {LOG_SQL}, s AS (SELECT DISTINCT {STAMP} AS t FROM log WHERE page = 'purchase')
SELECT t AS start_time, {PARTS}, CAST(isodow(t) - 1 AS INTEGER) AS weekday FROM s"""
)
def time_dim(spark, folder):
    log = music.plays(activity_log(spark, folder), PLAY)
    return _time(music.time_dim(log, epoch_ms_to_ts(F.col("ts"))))


@query(
    f"""WITH {LOG_SQL}, s AS (SELECT DISTINCT date_trunc('hour', {STAMP}) AS t FROM log)
SELECT t AS start_time, {PARTS}, CAST(dayofweek(t) AS INTEGER) AS weekday FROM s"""
)
def time_dim_hourly(spark, folder):
    hours = F.date_trunc("hour", epoch_ms_to_ts(F.col("ts")))
    return _time(music.time_dim(activity_log(spark, folder), hours, weekday="sunday0"))


@query(
    f"""WITH {LOG_SQL}, s AS (SELECT DISTINCT {STAMP} AS t FROM log WHERE page = 'purchase')
SELECT t AS start_time, {PARTS}, dayname(t) AS weekday FROM s"""
)
def time_dim_named(spark, folder):
    log = music.plays(activity_log(spark, folder), PLAY)
    return _time(music.time_dim(log, epoch_ms_to_ts(F.col("ts")), weekday="name"))


STRICT = """strict AS (
  SELECT md5(CAST(coalesce(l.userId, -1) AS VARCHAR) ||
             strftime(date_trunc('second', make_timestamp(l.ts * 1000)), '%Y-%m-%d %H:%M:%S')) AS songplay_id,
         date_trunc('second', make_timestamp(l.ts * 1000)) AS start_time, coalesce(l.userId, -1) AS user_id,
         l.level, m.song_id, m.artist_id, l.sessionId AS session_id, l.location, l.userAgent AS user_agent
  FROM log l JOIN meta m ON l.song = m.title AND l.artist = m.artist_name
       AND CAST(l.length AS DECIMAL(18,0)) = CAST(m.duration AS DECIMAL(18,0))
  WHERE l.page = 'purchase')"""


@query(
    f"""{BASE}, {STRICT}
SELECT start_time, CAST(hour(start_time) AS INTEGER) AS hour, CAST(day(start_time) AS INTEGER) AS day,
CAST(week(start_time) AS INTEGER) AS week, CAST(month(start_time) AS INTEGER) AS month,
CAST(year(start_time) AS INTEGER) AS year, CAST(dayofweek(start_time) AS INTEGER) AS weekday FROM strict"""
)
def time_dim_from_fact(spark, folder):
    """No distinct: one row per fact row."""
    fact = music.songplays_strict(activity_log(spark, folder), song_metadata(spark, folder), PLAY)
    return _time(music.time_dim(fact, F.col("start_time"), weekday="sunday0", distinct=False))


# -- fact ----------------------------------------------------------------------


@query(f"{BASE}, {STRICT} SELECT * FROM strict")
def songplays_strict_join(spark, folder):
    return _time(music.songplays_strict(activity_log(spark, folder), song_metadata(spark, folder), PLAY))


@query(
    f"""{BASE}, {STRICT} SELECT songplay_id, user_id, start_time, count(*) AS plays
FROM strict GROUP BY songplay_id, user_id, start_time"""
)
def songplay_md5_key(spark, folder):
    """Plays per hashed key; plays of one user within a second share a key."""
    fact = music.songplays_strict(activity_log(spark, folder), song_metadata(spark, folder), PLAY)
    return _time(fact.groupBy("songplay_id", "user_id", "start_time").agg(F.count(F.lit(1)).alias("plays")))


@query(
    f"""{BASE} SELECT strftime(make_timestamp(l.ts * 1000), '%Y-%m-%d %H:%M:%S') AS start_time,
CAST(l.userId AS VARCHAR) AS user_id, l.level, m.song_id, m.artist_id, l.sessionId AS session_id, l.location,
l.userAgent AS user_agent
FROM log l JOIN meta m ON l.song = m.title JOIN meta a ON a.artist_id = m.artist_id
WHERE l.page = 'purchase'"""
)
def songplays_title_join(spark, folder):
    """Title join, then artists with duplicates: every play repeats per song and artist row."""
    metadata = song_metadata(spark, folder)
    fact = music.songplays_lake(
        activity_log(spark, folder), music.songs_dim(metadata, "all"), music.artists_dim(metadata, "all"), PLAY
    )
    return as_text(fact, "user_id")


@query(
    f"""{BASE}, lookup AS (
  SELECT title, artist_name, duration, song_id, artist_id, row_number() OVER
    (PARTITION BY title, artist_name, duration ORDER BY song_id, artist_id) AS rn FROM meta),
played AS (
  SELECT *, row_number() OVER (PARTITION BY ts, userId ORDER BY level, song, artist, length, sessionId,
    location, userAgent) AS rn FROM log WHERE page = 'purchase')
SELECT make_timestamp(l.ts * 1000) AS start_time, CAST(l.userId AS VARCHAR) AS user_id, l.level, m.song_id, m.artist_id,
l.sessionId AS session_id, l.location, l.userAgent AS user_agent
FROM played l LEFT JOIN lookup m ON l.song = m.title AND l.artist = m.artist_name
AND l.length = m.duration AND m.rn = 1 WHERE l.rn = 1"""
)
def songplays_lookup_nullable(spark, folder):
    metadata = song_metadata(spark, folder)
    fact = music.songplays_keyed(
        activity_log(spark, folder), music.songs_dim(metadata, "first"), music.artists_dim(metadata, "first"), PLAY
    )
    return as_text(_time(fact), "user_id")


HOURLY = f"""hourly AS (
  SELECT date_trunc('hour', make_timestamp(l.ts * 1000)) AS start_time, l.userId AS user_id, l.level,
         m.song_id, m.artist_id, l.sessionId AS session_id, l.location, l.userAgent AS user_agent
  FROM log l JOIN meta m ON l.song = m.title)"""


@query(f"{BASE}, {HOURLY} SELECT * REPLACE (CAST(user_id AS VARCHAR) AS user_id) FROM hourly")
def songplays_hour_grain(spark, folder):
    fact = music.songplays_warehouse(activity_log(spark, folder), song_metadata(spark, folder))
    return as_text(_time(fact), "user_id")


# -- keys ----------------------------------------------------------------------


@query(
    """SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_id
FROM orders"""
)
def surrogate_key_dense(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderdate", "o_orderkey", "o_custkey")
    return dense_ids(orders, ["o_orderdate", "o_orderkey"], "order_id").select("o_orderkey", "o_custkey", "order_id")


@query("SELECT count(*) AS rows, count(*) AS ids FROM orders")
def surrogate_key_gaps(spark, folder):
    """The ids themselves differ from plan to plan; what holds is that they are unique."""
    ids = gap_ids(table(spark, folder, "orders").select("o_orderkey"), "id")
    return ids.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"))


@query("SELECT count(*) AS rows, count(*) AS ids, count(*) AS customers FROM orders")
def surrogate_key_two_writers(spark, folder):
    """Two loads number their half of the orders at the same time; no id comes twice."""
    orders, root = table(spark, folder, "orders").select("o_orderkey", "o_custkey"), scratch_path(spark, "reserved")

    def write(half):
        mine = orders.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(2)) == half)
        load(reserved_ids(mine, ["o_orderkey"], "id", f"{root}/ids", block=1000), f"{root}/half{half}")

    with ThreadPoolExecutor(2) as writers:
        list(writers.map(write, (0, 1)))
    both = spark.read.parquet(f"{root}/half0", f"{root}/half1")
    return both.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"), F.count("o_custkey").alias("customers")
    )


# -- reports -------------------------------------------------------------------


PLAYS_BY_USER = f"""{BASE}, {HOURLY},
users AS (SELECT DISTINCT userId AS user_id, lastName AS last_name FROM log WHERE userId IS NOT NULL),
songs AS (SELECT DISTINCT song_id FROM meta), artists AS (SELECT DISTINCT artist_id FROM meta),
time AS (SELECT DISTINCT date_trunc('hour', make_timestamp(ts * 1000)) AS start_time FROM log)
SELECT p.user_id, u.last_name, count(DISTINCT p.song_id) AS songs_played,
       count(DISTINCT p.artist_id) AS artists_played
FROM hourly p JOIN users u ON u.user_id = p.user_id JOIN songs s ON s.song_id = p.song_id
JOIN time t ON t.start_time = p.start_time JOIN artists a ON a.artist_id = p.artist_id
WHERE month(t.start_time) = 1 GROUP BY p.user_id, u.last_name"""


@query(PLAYS_BY_USER)
def star_plays_by_user(spark, folder):
    """Distinct songs and artists per user in January, over the fact and its four dimensions."""
    log, metadata = activity_log(spark, folder), song_metadata(spark, folder)
    hours = F.date_trunc("hour", epoch_ms_to_ts(F.col("ts")))
    return reports.plays_by_user(
        music.songplays_warehouse(log, metadata),
        music.users_dim(log),
        music.songs_dim(metadata, "all"),
        music.artists_dim(metadata, "all"),
        music.time_dim(log, hours, weekday="sunday0"),
        month=1,
    )


@query(PLAYS_BY_USER)
def plays_by_user_bitmaps(spark, folder):
    """The same report from bitmaps kept per ten days, of which the last are loaded twice, merged over all of January."""
    log, metadata = activity_log(spark, folder), song_metadata(spark, folder)
    plays = music.songplays_warehouse(log, metadata)
    root, day = scratch_path(spark, "listening"), F.dayofmonth("start_time")
    half = F.pmod(F.xxhash64("song_id"), F.lit(2)) == 0
    numbers = {}
    for known in (metadata.where(half), metadata):  # half of the songs become known later
        numbers = {key: rollups.number_keys(known, f"{root}/{key}", key) for key in rollups.HEARD}
    for days in (day < 20, day >= 20, day >= 20):
        kept = rollups.keep_listening(plays.where(days), numbers, F.floor(day / 10), f"{root}/bits")
    return rollups.heard_by_user(kept, music.users_dim(log), 0, 3)


@query(
    f"""WITH {META_SQL}, names AS (SELECT DISTINCT artist_id, artist_name FROM meta)
SELECT m.song_id, m.title, m.artist_id, m.year, m.duration, n.artist_name AS name
FROM meta m JOIN names n ON n.artist_id = m.artist_id"""
)
def dim_dim_join(spark, folder):
    metadata = song_metadata(spark, folder)
    return reports.song_artist_pairs(music.songs_dim(metadata), music.artists_dim(metadata, "first")).select(
        "song_id", "title", "artist_id", "year", "duration", "name"
    )
