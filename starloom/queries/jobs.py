"""End-to-end jobs and the layouts they write: files derived from the given tables in, tables out."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from starloom.operators.frames import conform
from starloom.plans import jobs
from starloom.plans.quality import QualityError
from starloom.queries.arrivals import FACT as ARRIVALS_FACT
from starloom.queries.inputs import (
    ARRIVALS_SQL,
    DAY_ONE,
    LOG_SQL,
    META_SQL,
    PLAY,
    activity_log,
    arrivals_raw,
    demographics,
    label_lines,
    song_metadata,
    temperatures,
)
from starloom.queries.loads import BATCHES, PICK, _batches
from starloom.queries.music import HOURLY, STRICT
from starloom.queries.registry import as_text, plain, query, table
from starloom.schemas import EVENT_CSV, contract
from starloom.session import scratch_path
from starloom.sinks import layout
from starloom.sinks.loads import export_csv, land_raw, load, read_as, replace_partitions
from starloom.sources import files
from starloom.streaming.hourly import run_hourly
from starloom.streaming.intake import run_intake

FACT = ["start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location", "user_agent"]
BASE = f"WITH {LOG_SQL},\n{META_SQL}\n"
USER_AS_TEXT = "* REPLACE (CAST(user_id AS VARCHAR) AS user_id, CAST(session_id AS INTEGER) AS session_id)"


def _music_files(spark, folder):
    """The log below log/2024/1 (all events lie in that month) and the songs, as JSON; returns their root."""
    root = scratch_path(spark, "job")
    page = F.when(F.col("page") == PLAY, "NextSong").otherwise(F.col("page"))
    activity_log(spark, folder).withColumn("page", page).write.json(f"{root}/log/2024/1")
    song_metadata(spark, folder).write.json(f"{root}/songs")
    return root


def _star(spark, folder, rules, runs=1, mode="errorifexists"):
    root = _music_files(spark, folder)
    for _ in range(runs):
        tables = jobs.build_music_star(spark, f"{root}/log/2024/1", f"{root}/songs", f"{root}/star", rules, mode)
    return tables["songplays"]


# -- jobs ----------------------------------------------------------------------


@query(
    f"""{BASE} SELECT strftime(make_timestamp(l.ts * 1000), '%Y-%m-%d %H:%M:%S') AS start_time,
CAST(l.userId AS VARCHAR) AS user_id, l.level, m.song_id, m.artist_id, CAST(l.sessionId AS INTEGER) AS session_id,
l.location, l.userAgent AS user_agent
FROM log l JOIN meta m ON l.song = m.title JOIN meta a ON a.artist_id = m.artist_id
WHERE l.page = 'purchase'"""
)
def job_lake_star(spark, folder):
    return as_text(_star(spark, folder, "lake").select(*FACT), "user_id")


@query(f"{BASE}, {HOURLY} SELECT {USER_AS_TEXT} FROM hourly")
def job_warehouse_star(spark, folder):
    fact = _star(spark, folder, "warehouse").select(*FACT)
    return as_text(fact.withColumn("start_time", plain(F.col("start_time"))), "user_id")


@query(
    f"""{BASE}, played AS (
  SELECT *, row_number() OVER (PARTITION BY ts, userId ORDER BY level, song, artist, length, sessionId,
    location, userAgent) AS rn FROM log WHERE page = 'purchase'),
kept AS (SELECT *, row_number() OVER (ORDER BY ts, userId NULLS FIRST) AS songplay_id FROM played WHERE rn = 1)
SELECT songplay_id, make_timestamp(ts * 1000) AS start_time, CAST(userId AS VARCHAR) AS user_id, level,
CAST(sessionId AS INTEGER) AS session_id FROM kept"""
)
def job_keyed_star(spark, folder):
    """Two runs over the same files: the second adds nothing, ids have no gaps."""
    fact = _star(spark, folder, "keyed", 2, "insert_if_absent")
    fact = fact.select("songplay_id", "start_time", "user_id", "level", "session_id")
    return as_text(fact.withColumn("start_time", plain(F.col("start_time"))), "user_id")


@query(f"{BASE}, {STRICT} SELECT DISTINCT songplay_id, start_time, user_id FROM strict")
def job_hourly(spark, folder):
    """Two runs of one date leave one row per key."""
    root = _music_files(spark, folder)
    for day in ("2024-01-05", "2024-01-31"):
        run_hourly(spark, day, f"{root}/log/{{year}}/{{month}}", f"{root}/songs", f"{root}/wh")
    fact = spark.read.parquet(f"{root}/wh/songplays").select("songplay_id", "start_time", "user_id")
    return fact.withColumn("start_time", plain(F.col("start_time")))


@query(
    f"""{BASE}, played AS (
  SELECT *, row_number() OVER (PARTITION BY ts, userId ORDER BY event_id % 2, level, song, artist, length, sessionId,
    location, userAgent) AS rn FROM log WHERE page = 'purchase'),
kept AS (SELECT *, row_number() OVER (ORDER BY event_id % 2, ts, userId NULLS FIRST) AS songplay_id FROM played WHERE rn = 1)
SELECT songplay_id, make_timestamp(ts * 1000) AS start_time, CAST(userId AS VARCHAR) AS user_id, level,
CAST(sessionId AS INTEGER) AS session_id FROM kept"""
)
def job_keyed_incremental(spark, folder):
    """Two runs with half of the log each, then one that finds no new file; ids go on."""
    root = scratch_path(spark, "intake")
    page = F.when(F.col("page") == PLAY, "NextSong").otherwise(F.col("page"))
    log = activity_log(spark, folder).withColumn("page", page)
    song_metadata(spark, folder).write.json(f"{root}/songs")
    for half in (0, 1):
        log.where(F.col("event_id") % 2 == half).write.json(f"{root}/log/{half}")
        run_intake(spark, f"{root}/log", f"{root}/songs", f"{root}/star")
    run_intake(spark, f"{root}/log", f"{root}/songs", f"{root}/star")
    fact = spark.read.parquet(f"{root}/star/tables/songplays")
    fact = fact.select("songplay_id", "start_time", "user_id", "level", "session_id")
    return as_text(fact.withColumn("start_time", plain(F.col("start_time"))), "user_id")


@query(
    f"""{BASE}, {STRICT} SELECT DISTINCT 'visible' AS kind, songplay_id AS value FROM strict WHERE day(start_time) <= 10
UNION ALL SELECT 'rejected', event_id || ' is no record' FROM log WHERE day(make_timestamp(ts * 1000)) > 10"""
)
def job_hourly_rejected(spark, folder):
    """A run with too many bad lines keeps these and leaves the tables of the run before as they were."""
    root = scratch_path(spark, "rejected")
    page = F.when(F.col("page") == PLAY, "NextSong").otherwise(F.col("page"))
    log = activity_log(spark, folder).withColumn("page", page)
    early = F.dayofmonth(F.timestamp_millis("ts")) <= 10
    log.where(early).write.json(f"{root}/log/2024/1")
    song_metadata(spark, folder).write.json(f"{root}/songs")
    args = (f"{root}/log/{{year}}/{{month}}", f"{root}/songs", f"{root}/wh")
    run_hourly(spark, "2024-01-10", *args, most_rejected=0.0)
    bad = log.where(~early).select(F.concat(F.col("event_id").cast("string"), F.lit(" is no record")).alias("value"))
    bad.write.mode("append").text(f"{root}/log/2024/1")
    log.where(~early).write.mode("append").json(f"{root}/log/2024/1")
    try:
        run_hourly(spark, "2024-01-31", *args, most_rejected=0.1)
    except QualityError:
        pass
    else:
        raise AssertionError("the run with bad lines was not stopped")
    fact = spark.read.parquet(f"{root}/wh/songplays").select(F.lit("visible").alias("kind"), F.col("songplay_id").alias("value"))
    rejects = spark.read.parquet(f"{root}/wh/rejects/run_date=2024-01-31")
    return fact.unionAll(rejects.select(F.lit("rejected"), "text"))


@query(
    f"""WITH {LOG_SQL} SELECT artist, song, CAST(CAST(event_id % 1000 AS INTEGER) AS VARCHAR) AS "itemInSession",
CAST(userId AS VARCHAR) AS "userId", CAST(sessionId AS VARCHAR) AS "sessionId" FROM log WHERE artist IS NOT NULL"""
)
def job_lookups_csv(spark, folder):
    """The copy of the plays that the lookup job writes next to its three tables."""
    root = scratch_path(spark, "lookups")
    log = activity_log(spark, folder).withColumn("itemInSession", F.col("event_id") % 1000)
    export_csv(conform(log, EVENT_CSV), f"{root}/events")
    jobs.build_lookups(spark, f"{root}/events", f"{root}/out")
    plays = files.read_csv(spark, f"{root}/out/plays_csv")
    return plays.select("artist", "song", "itemInSession", "userId", "sessionId")


@query(f"WITH {ARRIVALS_SQL}, {ARRIVALS_FACT} SELECT * FROM fact")
def job_arrivals_star(spark, folder):
    """Two Parquet files of arrivals, three CSV sources and the label text, landed raw, then built and checked."""
    root = scratch_path(spark, "arrivals")
    raw = arrivals_raw(spark, folder)
    raw.where("i94mon <= 6").write.parquet(f"{root}/first")
    raw.where("i94mon > 6").withColumn("insnum", F.lit(1)).write.parquet(f"{root}/second")
    temperatures(spark, folder).write.csv(f"{root}/temperatures", header=True)
    demographics(spark, folder).write.csv(f"{root}/demographics", header=True, sep=";")
    table(spark, folder, "supplier").select("s_suppkey", "s_name").write.csv(f"{root}/airports", header=True)
    # the countries are the nations; the label lines of customers give states and cities
    names = table(spark, folder, "nation").selectExpr(r"concat(lpad(n_nationkey, 3, '0'), ' =  \'', n_name, '\'') AS value")
    others = label_lines(spark, folder).select(F.regexp_replace("value", r"[0-9]{3} =  '[^']*'\n", "").alias("value"))
    names.unionAll(others).write.text(f"{root}/labels")
    months = [f"{root}/first", f"{root}/second"]
    jobs.land_arrivals(
        spark, months, f"{root}/temperatures", f"{root}/demographics", f"{root}/airports", f"{root}/lake"
    )
    jobs.build_arrivals_star(spark, f"{root}/lake", f"{root}/labels", f"{root}/star", DAY_ONE, 1998)
    fact = spark.read.parquet(f"{root}/star/ops/immigrations_table")
    return fact.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("arrdate_ts", "depdate_ts")})


# -- layouts and raw copies ------------------------------------------------------


@query(
    """SELECT 'customer' AS kind, c_custkey AS the_key, c_name AS the_name FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier"""
)
def land_and_restore(spark, folder):
    """Raw copies get clean column names and come back under their folder's name."""
    root = scratch_path(spark, "raw")
    customers = table(spark, folder, "customer").selectExpr("c_custkey AS `the-key`", "c_name AS `the name`")
    suppliers = table(spark, folder, "supplier").selectExpr("s_suppkey AS `the-key`", "s_name AS `the name`")
    land_raw({"customer": customers, "supplier": suppliers}, root)
    found = files.restore_tables(spark, f"{root}/raw")
    named = [df.select(F.lit(name).alias("kind"), "the_key", "the_name") for name, df in found.items()]
    return named[0].unionByName(named[1])


@query(
    f"""WITH {BATCHES} SELECT * FROM one WHERE event_type NOT IN ('purchase', 'error')
UNION ALL SELECT * FROM two WHERE event_type IN ('purchase', 'error')"""
)
def replace_some_partitions(spark, folder):
    """Partitions that the second batch holds are replaced; the other ones stay."""
    first, second = _batches(spark, folder)
    path = scratch_path(spark, "parts")
    load(first, path, partition_by=["event_type"])
    replace_partitions(second.where("event_type IN ('purchase', 'error')"), path, ["event_type"])
    return read_as(first, path)


@query(
    """SELECT o_orderkey, o_custkey, count(*) AS lines FROM orders JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY o_orderkey, o_custkey"""
)
def bucketed_join(spark, folder):
    """Two tables in equal buckets of the join key."""
    found = {}
    for name, columns in (("orders", ["o_orderkey", "o_custkey"]), ("lineitem", ["l_orderkey", "l_linenumber"])):
        own = f"{name}_{uuid.uuid4().hex}"
        rows = table(spark, folder, name).select(*columns)
        layout.write_bucketed(rows, own, scratch_path(spark, name), columns[:1], columns[:1], 8)
        found[name] = spark.table(own)
        layout.drop_table(spark, own)  # external: the files stay
    joined = found["orders"].join(found["lineitem"], F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderkey", "o_custkey").agg(F.count(F.lit(1)).alias("lines"))


@query(f"SELECT {PICK} FROM events")
def declared_table(spark, folder):
    """Declared twice, filled once, dropped: the files stay."""
    name, path = f"events_{uuid.uuid4().hex}", scratch_path(spark, "declared")
    rows = table(spark, folder, "events").selectExpr("event_id", "user_id", "event_type", "value")
    schema = contract(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema))
    for _ in range(2):
        layout.create_table(spark, name, schema, path)
    rows.write.insertInto(name)
    layout.drop_tables(spark, [name])
    return read_as(rows, path)


@query("SELECT c_nationkey, min(c_custkey) AS c_custkey FROM customer GROUP BY c_nationkey")
def first_of_each_file(spark, folder):
    """One JSON file per nation, its customers in order: the first record of each file."""
    path = scratch_path(spark, "firsts")
    customers = table(spark, folder, "customer").select("c_nationkey", "c_custkey", F.col("c_nationkey").alias("nation"))
    placed = customers.repartition("nation").sortWithinPartitions("nation", "c_custkey")
    placed.write.partitionBy("nation").json(path)
    kinds = {f.name: f.dataType.simpleString() for f in customers.schema}
    schema = f"c_nationkey {kinds['c_nationkey']}, c_custkey {kinds['c_custkey']}"
    records = spark.read.schema(schema).option("recursiveFileLookup", True).json(path)
    return files.first_record_per_file(records)
