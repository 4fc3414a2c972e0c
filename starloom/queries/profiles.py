"""Counts, profiles, top rows and point lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions.timeparts import epoch_ms_to_ts
from starloom.operators.dedup import last_per_key
from starloom.operators.frames import duplicate_report, null_profile, outer_union, table_shape, top_n
from starloom.plans import lookups, music
from starloom.queries.inputs import LOG_SQL, PLAY, activity_log
from starloom.queries.registry import query, table
from starloom.session import scratch_path


@query(
    """SELECT 'events' AS "table", (SELECT count(*) FROM events) AS rows, 6::BIGINT AS cols
UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem), 11
UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), 6"""
)
def run_table_shape(spark, folder):
    return table_shape({name: table(spark, folder, name) for name in ("events", "lineitem", "orders")})


@query(
    f"""WITH {LOG_SQL} SELECT count(song) AS songs, count(userId) AS users, count(*) AS lines FROM log"""
)
def count_non_null(spark, folder):
    return activity_log(spark, folder).agg(
        F.count("song").alias("songs"), F.count("userId").alias("users"), F.count(F.lit(1)).alias("lines")
    )


@query("SELECT max(l_extendedprice) AS max_price, max(l_shipdate) AS last_ship FROM lineitem")
def max_value(spark, folder):
    return table(spark, folder, "lineitem").agg(
        F.max("l_extendedprice").alias("max_price"), F.max("l_shipdate").alias("last_ship")
    )


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def run_top_n(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return top_n(orders, [F.desc("o_totalprice"), "o_orderkey"], 10)


PROFILED = ["event_id", "userId", "level", "song", "artist", "length"]


@query(
    f"WITH {LOG_SQL}, n AS (SELECT count(*) AS total FROM log) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls,
round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS percent FROM log"""
        for c in PROFILED
    )
)
def run_null_profile(spark, folder):
    return null_profile(activity_log(spark, folder).select(*PROFILED))


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
)
def run_duplicate_report(spark, folder):
    return duplicate_report(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


# -- lookups -----------------------------------------------------------------------


@query("SELECT l_partkey, l_suppkey, l_quantity FROM lineitem WHERE l_orderkey = 12 AND l_linenumber = 5")
def lookup_by_compound_key(spark, folder):
    lines = table(spark, folder, "lineitem")
    return lookups.find(lines, ["l_partkey", "l_suppkey", "l_quantity"], l_orderkey=12, l_linenumber=5)


def _event_rows(spark, folder):
    """The plays in the shape of the event files; the hour numbers the items of a session."""
    log = music.plays(activity_log(spark, folder), PLAY).where(F.col("userId").isNotNull())
    return log.withColumn("itemInSession", F.hour(epoch_ms_to_ts(F.col("ts"))))


ROWS = f"""WITH {LOG_SQL}, rows AS (SELECT *, CAST(hour(make_timestamp(ts * 1000)) AS INTEGER) AS itemInSession
FROM log WHERE page = 'purchase' AND userId IS NOT NULL)"""


@query(f"{ROWS} SELECT song, artist, firstName, lastName, itemInSession FROM rows WHERE userId = 9 AND sessionId = 91")
def lookup_sorted_session(spark, folder):
    """One session's plays in clustering order, filtered where they lie."""
    return lookups.find(
        _event_rows(spark, folder),
        ["song", "artist", "firstName", "lastName", "itemInSession"],
        ["itemInSession"],
        userId=9,
        sessionId=91,
    )


@query(f"{ROWS} SELECT DISTINCT song, firstName, lastName, userId FROM rows WHERE song = 'Track 9'")
def lookup_listeners_of_song(spark, folder):
    """Every listener of one song once; the filter on the key runs before the reduction."""
    heard = lookups.find(_event_rows(spark, folder), ["song", "userId", "firstName", "lastName"], song="Track 9")
    return last_per_key(heard, ["song", "userId"], ["firstName"]).select("song", "firstName", "lastName", "userId")


ANSWERS = f"""{ROWS}, written AS (SELECT *, row_number() OVER (PARTITION BY sessionId, itemInSession
  ORDER BY ts DESC, artist DESC, song DESC, length DESC) AS rn FROM rows)
SELECT 'play' AS asked, song, artist, NULL AS firstName, NULL AS lastName FROM written
  WHERE sessionId = 91 AND itemInSession = 1 AND rn = 1
UNION ALL SELECT 'session', song, artist, firstName, lastName FROM written WHERE userId = 9 AND sessionId = 91 AND rn = 1
UNION ALL SELECT DISTINCT 'listeners', song, NULL, firstName, lastName FROM rows WHERE song = 'Track 9'"""


@query(ANSWERS)
def lookup_tables_answers(spark, folder):
    """The three laid-out tables are written (the last write per key wins), then each answers its question."""
    root = scratch_path(spark, "lookups")
    lookups.build_lookup_tables(_event_rows(spark, folder), root, ["ts"])
    answers = {
        "play": lookups.play_in_session(spark, root, 91, 1).drop("length"),
        "session": lookups.plays_of_session(spark, root, 9, 91),
        "listeners": lookups.listeners_of_song(spark, root, "Track 9"),
    }
    return outer_union(*[rows.withColumn("asked", F.lit(asked)) for asked, rows in answers.items()]).select(
        "asked", "song", "artist", "firstName", "lastName"
    )


@query(ANSWERS)
def lookup_one_copy(spark, folder):
    """The same questions to one table that is clustered by all their keys."""
    path = scratch_path(spark, "one-copy")
    lookups.build_one_copy(_event_rows(spark, folder), path, ["ts"])
    ask = lambda *args, **key: lookups.find_in_copy(spark, path, *args, ["ts"], **key)
    answers = {
        "play": ask("songInfo", ["artist", "song"], sessionId=91, itemInSession=1),
        "session": ask("sessionInfo", ["artist", "song", "firstName", "lastName"], userId=9, sessionId=91),
        "listeners": ask("userInfo", ["song", "firstName", "lastName"], song="Track 9"),
    }
    return outer_union(*[rows.withColumn("asked", F.lit(asked)) for asked, rows in answers.items()]).select(
        "asked", "song", "artist", "firstName", "lastName"
    )
