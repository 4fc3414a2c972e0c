"""Sources: files written from the given tables and read back through the readers, and JSON staging."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators.frames import conform, outer_union
from starloom.queries.inputs import LOG_SQL, META_SQL, activity_log, song_metadata
from starloom.queries.registry import as_text, query, table
from starloom.schemas import EVENT_CSV, contract
from starloom.session import scratch_path
from starloom.sinks.loads import export_csv
from starloom.sources import files, staging

MIDDLE = "2024-01-16"

# -- readers, over the whole derived log and catalogue --------------------------


@query(
    f"""WITH {LOG_SQL} SELECT ts, page, CAST(userId AS VARCHAR) AS userId, level, song, artist, length,
CAST(sessionId AS INTEGER) AS sessionId, location, userAgent FROM log"""
)
def scan_json_log(spark, folder):
    path = scratch_path(spark, "log")
    activity_log(spark, folder).write.json(path)
    return files.read_logs(spark, path).select(
        "ts", "page", "userId", "level", "song", "artist", "length", "sessionId", "location", "userAgent"
    )


@query(
    f"""WITH {META_SQL} SELECT song_id, title, artist_id, artist_name, artist_location, artist_latitude,
artist_longitude, duration, year FROM meta"""
)
def scan_nested_json(spark, folder):
    """Song files three folders deep."""
    path = scratch_path(spark, "songs")
    song_metadata(spark, folder).withColumns(
        {"a": F.lit("A"), "b": F.substring("title", -1, 1), "c": F.substring("song_id", -1, 1)}
    ).hint("rebalance", F.col("b"), F.col("c")).write.partitionBy("a", "b", "c").json(path)
    return files.read_songs(spark, path).select(
        "song_id", "title", "artist_id", "artist_name", "artist_location", "artist_latitude",
        "artist_longitude", "duration", "year",
    )


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer")
def scan_csv(spark, folder):
    path = scratch_path(spark, "csv")
    customers = table(spark, folder, "customer").drop("c_acctbal")
    export_csv(customers, path)
    return files.read_csv(spark, path, schema=contract("c_custkey string, c_name string, c_nationkey string, c_mktsegment string"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, 'a;b, c' AS note FROM supplier")
def scan_csv_semicolon(spark, folder):
    path = scratch_path(spark, "ssv")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name", F.lit("a;b, c").alias("note"))
    suppliers.write.option("header", True).option("sep", ";").csv(path)
    return files.read_csv(spark, path, sep=";", schema=contract("s_suppkey string, s_name string, note string"))


@query(
    f"""WITH {LOG_SQL} SELECT artist, firstName, gender, CAST(event_id % 1000 AS INTEGER) AS itemInSession, lastName,
length, level, location, CAST(sessionId AS INTEGER) AS sessionId, song, CAST(userId AS VARCHAR) AS userId
FROM log WHERE artist IS NOT NULL"""
)
def scan_event_csvs(spark, folder):
    """All columns written as quoted CSV; read back without the rows that name no artist."""
    path = scratch_path(spark, "event-csv")
    log = activity_log(spark, folder).withColumn("itemInSession", F.col("event_id") % 1000)
    export_csv(conform(log, EVENT_CSV), path)
    return as_text(files.read_event_csvs(spark, path), "userId")


# -- JSON staging ----------------------------------------------------------------


@query(
    """SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS song_number,
CAST(NULL AS VARCHAR) AS missing FROM events"""
)
def stage_jsonpath(spark, folder):
    """Paths fill columns by position; a path that leads nowhere gives NULL."""
    return staging.stage_by_path(
        table(spark, folder, "events"),
        "props",
        ["$.k", "$.not.there"],
        contract("song_number int, missing string"),
        keep=["event_id"],
    )


@query("SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS other FROM events")
def stage_by_name(spark, folder):
    """Keys fill the columns of the same name."""
    return staging.stage_by_name(
        table(spark, folder, "events"), "props", contract("other string, k int"), keep=["event_id"]
    )


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 5"""
)
def stage_run_month(spark, folder):
    month = staging.of_month(table(spark, folder, "orders"), "o_orderdate", "1997-05-10")
    return month.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query(
    """SELECT event_id, CASE WHEN event_id % 10 > 1 THEN CAST(CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS VARCHAR) END AS k,
CASE event_id % 10 WHEN 0 THEN replace(props, '}', '') WHEN 1 THEN '{"k": "x"}' END AS text FROM events"""
)
def stage_rejects(spark, folder):
    """Rows that fit the schema with their values, rows that do not with their text."""
    broken = table(spark, folder, "events").selectExpr(
        "event_id",
        """CASE event_id % 10 WHEN 0 THEN replace(props, '}', '') WHEN 1 THEN '{"k": "x"}' ELSE props END AS line""",
    )
    good, bad = staging.split_rejects(broken, "line", contract("k int"), keep=["event_id"])
    return as_text(outer_union(good, bad), "k")


# -- unions ----------------------------------------------------------------------


def _halves(spark, folder):
    events = table(spark, folder, "events")
    return events.where(f"ts < timestamp_ntz'{MIDDLE}'"), events.where(f"ts >= timestamp_ntz'{MIDDLE}'")


@query(
    """SELECT event_id, event_type, NULL::DOUBLE AS value, user_id FROM events WHERE ts < TIMESTAMP '2024-01-16'
UNION ALL SELECT event_id, NULL, value, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-16'"""
)
def run_outer_union(spark, folder):
    """The two halves of the month with different columns."""
    early, late = _halves(spark, folder)
    return outer_union(early.select("event_id", "event_type", "user_id"), late.select("user_id", "value", "event_id"))


@query(
    """SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-16' OR event_type <> 'error' THEN CAST(user_id AS VARCHAR) END
AS user_id, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN event_type END AS event_type FROM events"""
)
def monthly_type_drift(spark, folder):
    """Two Parquet files that disagree on a column's type, brought to one contract."""
    early, late = _halves(spark, folder)
    root = scratch_path(spark, "monthly")
    early.select("event_id", "user_id", "event_type").write.parquet(f"{root}/m1")
    late.selectExpr(
        "event_id", "if(event_type = 'error', 'unknown', cast(user_id as string)) AS user_id", "value"
    ).write.parquet(f"{root}/m2")
    months = files.read_monthly(
        spark, [f"{root}/m1", f"{root}/m2"], contract("event_id bigint, user_id int, event_type string")
    )
    return as_text(months, "user_id")
