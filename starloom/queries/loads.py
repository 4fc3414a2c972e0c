"""Load modes: the content of a table after a second batch that overlaps the first."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from starloom.operators.joins import sliced_join
from starloom.operators.keys import dense_ids
from starloom.queries.registry import query, table
from starloom.schemas import contract
from starloom.session import scratch_path
from starloom.sinks import versioned
from starloom.sinks.loads import insert_if_absent, insert_sorted, load, load_query, load_sorted, read_as, upsert

COLUMNS = ["event_id", "user_id", "event_type", "value"]
PICK = "event_id, user_id, event_type, value"


def _batches(spark, folder):
    """The events up to the 20th, then those from the 11th on with changed values: ten days come twice."""
    events = table(spark, folder, "events")
    first = events.where("ts < timestamp_ntz'2024-01-21'").select(*COLUMNS)
    second = events.where("ts >= timestamp_ntz'2024-01-11'").select(*COLUMNS)
    return first, second.withColumn("value", F.col("value") + 1000)


BATCHES = f"""one AS (SELECT {PICK} FROM events WHERE ts < TIMESTAMP '2024-01-21'),
two AS (SELECT event_id, user_id, event_type, value + 1000 AS value FROM events WHERE ts >= TIMESTAMP '2024-01-11')"""


@query(f"WITH {BATCHES} SELECT * FROM one UNION ALL SELECT * FROM two")
def append_load(spark, folder):
    first, second = _batches(spark, folder)
    path = scratch_path(spark, "append")
    load(first, path)
    return load(second, path, "append")


@query("SELECT event_type AS label, CAST(event_id AS VARCHAR) AS code FROM events")
def positional_load(spark, folder):
    """Selected columns fill the table's columns by position, whatever they are called."""
    table(spark, folder, "events").createOrReplaceTempView("loaded_events")
    select = "SELECT event_type AS anything, event_id FROM loaded_events"
    return load_query(spark, select, scratch_path(spark, "positional"), contract("label string, code string"))


@query(f"WITH {BATCHES} SELECT * FROM two")
def overwrite_load(spark, folder):
    first, second = _batches(spark, folder)
    path = scratch_path(spark, "overwrite")
    load(first, path, partition_by=["event_type"])
    return load(second, path, "overwrite", partition_by=["event_type"])


@query(f"WITH {BATCHES} SELECT * FROM one UNION ALL SELECT * FROM two WHERE event_id NOT IN (SELECT event_id FROM one)")
def run_insert_if_absent(spark, folder):
    """The second batch comes twice; only its new keys enter, once."""
    first, second = _batches(spark, folder)
    path = scratch_path(spark, "insert")
    load(first, path)
    insert_if_absent(second.unionAll(second), path, ["event_id"], ["value"])
    return read_as(first, path)


@query(f"WITH {BATCHES} SELECT * FROM two UNION ALL SELECT * FROM one WHERE event_id NOT IN (SELECT event_id FROM two)")
def upsert_last_write(spark, folder):
    """An older version of each row in the same batch loses to the newer one."""
    first, second = _batches(spark, folder)
    older = second.withColumn("value", F.col("value") - 500)
    path = scratch_path(spark, "upsert")
    load(first, path)
    upsert(older.unionAll(second), path, ["event_id"], ["value"])
    return read_as(first, path)


@query(f"WITH {BATCHES} SELECT * FROM two UNION ALL SELECT * FROM one WHERE event_id NOT IN (SELECT event_id FROM two)")
def upsert_bucketed(spark, folder):
    """The same batches into buckets of the key: only buckets that the batch touches are written anew."""
    first, second = _batches(spark, folder)
    older = second.withColumn("value", F.col("value") - 500)
    name, root = f"upsert_{uuid.uuid4().hex}", scratch_path(spark, "upsert-bucketed")
    versioned.create(spark, name, first.schema, root, ["event_id"], 8)
    versioned.upsert(spark, name, first, ["value"])
    versioned.upsert(spark, name, older.unionAll(second), ["value"])
    return versioned.read(spark, name)


@query(f"WITH {BATCHES} SELECT * FROM one UNION ALL SELECT * FROM two WHERE event_id NOT IN (SELECT event_id FROM one)")
def insert_sorted_keys(spark, folder):
    """The partition is not in the key: key ranges of the batch, not partitions, limit what is read."""
    first, second = _batches(spark, folder)
    path = scratch_path(spark, "insert-sorted")
    load_sorted(first, path, ["event_id"], partition_by=["event_type"])
    for _ in range(2):
        insert_sorted(second.unionAll(second), path, ["event_id"], ["value"], ["event_type"])
    return read_as(first, path)


@query("SELECT nullif(user_id % 50, 0) AS k, min(value) AS value FROM events GROUP BY 1")
def insert_if_absent_null_key(spark, folder):
    """NULL is a key like any other: three loads of a batch leave one row for it."""
    batch = table(spark, folder, "events").selectExpr("nullif(user_id % 50, 0) AS k", "value")
    path = scratch_path(spark, "insert-null")
    for _ in range(3):
        insert_if_absent(batch, path, ["k"], ["value"])
    return read_as(batch, path)


@query(
    f"""WITH {BATCHES}, merged AS (
    SELECT * FROM two UNION ALL SELECT * FROM one WHERE event_id NOT IN (SELECT event_id FROM two)
) SELECT event_id, value, nullif(event_id % 3, 0) AS part FROM merged"""
)
def upsert_null_partition(spark, folder):
    """Rows of the NULL partition that the batch does not touch stay."""
    first, second = (
        batch.selectExpr("event_id", "value", "nullif(event_id % 3, 0) AS part") for batch in _batches(spark, folder)
    )
    path = scratch_path(spark, "upsert-null")
    load(first, path, partition_by=["part"])
    upsert(second, path, ["event_id", "part"], ["value"], ["part"])
    return read_as(first, path)


@query(
    """WITH l AS (SELECT CASE WHEN event_id % 4 = 0 THEN 'nan'::DOUBLE ELSE user_id % 10 END AS k FROM events),
r AS (SELECT CASE WHEN n_nationkey >= 10 THEN 'nan'::DOUBLE ELSE n_nationkey END AS k FROM nation WHERE n_nationkey < 12)
SELECT isnan(k) AS nan, count(*) AS n FROM l JOIN r USING (k) GROUP BY 1"""
)
def join_nan_key(spark, folder):
    """NaN equals itself in a join, hot or not."""
    left = table(spark, folder, "events").selectExpr(
        "CASE WHEN event_id % 4 = 0 THEN double('nan') ELSE double(user_id % 10) END AS k"
    )
    right = table(spark, folder, "nation").where("n_nationkey < 12")
    right = right.selectExpr("CASE WHEN n_nationkey >= 10 THEN double('nan') ELSE double(n_nationkey) END AS k")
    joined = sliced_join(left, right, ["k"], hot_rows=100)
    return joined.groupBy(F.isnan("k").alias("nan")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT event_id, row_number() OVER (ORDER BY ts >= TIMESTAMP '2024-01-16', event_id) AS id FROM events"""
)
def surrogate_key_continued(spark, folder):
    """The ids of a second batch go on from the first."""
    events = table(spark, folder, "events")
    path = scratch_path(spark, "continued")
    first = events.where("ts < timestamp_ntz'2024-01-16'").select("event_id")
    have = load(dense_ids(first, ["event_id"], "id"), path)
    start = (have.agg(F.max("id")).first()[0] or 0) + 1
    second = events.where("NOT ts < timestamp_ntz'2024-01-16'").select("event_id")
    return load(dense_ids(second, ["event_id"], "id", start), path, "append")
