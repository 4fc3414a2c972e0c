"""Projection, filter and cleaning operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import text, timeparts
from starloom.operators.clean import cast_columns, like_prefix, matched_only
from starloom.plans import lookups, music
from starloom.queries.inputs import LOG_SQL, PLAY, activity_log
from starloom.queries.registry import as_text, plain, query, table


@query("SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS segment FROM customer")
def scan_project(spark, folder):
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(trunc(o_totalprice) AS INTEGER) AS o_totalprice,
CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority, CAST(NULL AS VARCHAR) AS o_orderstatus FROM orders"""
)
def run_cast_columns(spark, folder):
    """Double to whole number, text to number, and text that is no number to NULL."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", F.substring("o_orderpriority", 1, 1).alias("priority"), "o_orderstatus"
    )
    kinds = {"o_orderkey": "string", "o_totalprice": "int", "priority": "int", "o_orderstatus": "int"}
    return as_text(cast_columns(orders, kinds), "o_orderstatus")


@query("SELECT p_partkey AS part_key, p_name AS Part_Name, p_brand AS Brand_of_part FROM part")
def normalize_headers(spark, folder):
    messy = table(spark, folder, "part").select(
        F.col("p_partkey").alias("part-key"), F.col("p_name").alias("Part Name"), F.col("p_brand").alias("Brand of-part")
    )
    return text.clean_headers(messy)


@query(f"WITH {LOG_SQL} SELECT event_id, CAST(userId AS VARCHAR) AS userId, song FROM log WHERE page = 'purchase'")
def filter_action(spark, folder):
    return as_text(music.plays(activity_log(spark, folder), PLAY).select("event_id", "userId", "song"), "userId")


@query(f"WITH {LOG_SQL} SELECT event_id, artist FROM log WHERE event_id % 3 <> 0 AND artist IS NOT NULL")
def filter_non_empty(spark, folder):
    """Rows whose artist is neither NULL nor empty; every third one was made empty before."""
    log = activity_log(spark, folder).select("event_id", F.expr("if(event_id % 3 = 0, '', artist)").alias("artist"))
    return log.where(text.non_empty(F.col("artist")))


@query(
    """SELECT event_id, song_id, artist_id FROM (
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'None' WHEN event_id % 7 = 0 THEN NULL
ELSE 'S' || user_id END AS song_id, CASE WHEN event_id % 11 = 0 THEN 'None' ELSE event_type END AS artist_id FROM events)
WHERE song_id <> 'None' AND artist_id <> 'None'"""
)
def filter_matched_only(spark, folder):
    found = table(spark, folder, "events").selectExpr(
        "event_id",
        "CASE WHEN event_id % 5 = 0 THEN 'None' WHEN event_id % 7 <> 0 THEN concat('S', user_id) END AS song_id",
        "if(event_id % 11 = 0, 'None', event_type) AS artist_id",
    )
    return matched_only(found, ["song_id", "artist_id"])


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'blue%'")
def like_prefix_filter(spark, folder):
    return like_prefix(table(spark, folder, "part"), "p_name", "blue").select("p_partkey", "p_name")


@query("SELECT p_partkey, p_brand, p_size FROM part WHERE p_name = 'blue ring'")
def filter_equal(spark, folder):
    return lookups.find(table(spark, folder, "part"), ["p_partkey", "p_brand", "p_size"], p_name="blue ring")


@query("SELECT c_custkey, replace('O''' || c_name || '''s', '''', '') AS name FROM customer")
def strip_quotes(spark, folder):
    quoted = F.concat(F.lit("O'"), "c_name", F.lit("'s"))
    return table(spark, folder, "customer").select("c_custkey", text.strip_quotes(quoted).alias("name"))


# -- times -----------------------------------------------------------------------


def _stamps(spark, folder):
    return table(spark, folder, "events").selectExpr("event_id", "unix_millis(cast(ts as timestamp)) AS ms")


@query("SELECT event_id, date_trunc('millisecond', ts) AS start_time FROM events")
def epoch_ms_to_ts(spark, folder):
    return _stamps(spark, folder).select("event_id", plain(timeparts.epoch_ms_to_ts(F.col("ms"))).alias("start_time"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS start_time FROM events")
def epoch_ms_to_string(spark, folder):
    return _stamps(spark, folder).select("event_id", timeparts.epoch_ms_to_text(F.col("ms")).alias("start_time"))


@query("SELECT event_id, date_trunc('second', ts) AS start_time FROM events")
def epoch_s_trunc(spark, folder):
    second = timeparts.epoch_ms_to_second(F.col("ms"))
    return _stamps(spark, folder).select("event_id", plain(second).alias("start_time"))


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS lines,
CAST(sum(date_diff('day', CAST(l_shipdate AS DATE), DATE '2002-01-01')) AS BIGINT) AS days_left FROM lineitem GROUP BY 1, 2"""
)
def days_between(spark, folder):
    left = F.datediff(F.lit("2002-01-01").cast("date"), F.col("l_shipdate").cast("date"))
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum(left).alias("days_left"))
    )
