"""Upserts into buckets, and inserts that read only the key ranges of their batch."""

import os

import pytest

from starloom.operators.merge import absent_rows
from starloom.sinks import versioned
from starloom.sinks.loads import in_key_ranges, insert_sorted, load_sorted, read_as

SCHEMA = "k bigint, part string, v int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def table(spark, tmp_path, request):
    name = f"versioned_{abs(hash(request.node.name))}"
    batch = spark.createDataFrame([(k, "p", 0) for k in range(1000)] + [(None, "p", 0)], SCHEMA)
    versioned.create(spark, name, batch.schema, str(tmp_path / "t"), ["k"], 16)
    versioned.upsert(spark, name, batch, ["v"])
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_only_touched_buckets_are_written(spark, table):
    before = versioned.shown_folders(spark, table)
    files = {f: os.stat(f).st_mtime_ns for folder in before.values() for f in _files(folder)}
    batch = spark.createDataFrame([(5, "q", 1), (5, "q", 2), (None, "q", 3)], SCHEMA)
    touched = versioned.upsert(spark, table, batch, ["v"])
    after = versioned.shown_folders(spark, table)
    assert 1 <= len(touched) <= 2 and {b for b in after if after[b] != before[b]} == set(touched)
    assert files == {f: os.stat(f).st_mtime_ns for f in files}  # nothing that was visible has changed
    expected = [(k, "p", 0) for k in range(1000) if k != 5] + [(5, "q", 2), (None, "q", 3)]
    assert rows(versioned.read(spark, table)) == sorted(expected, key=repr)
    assert versioned.drop_old_versions(spark, table) == 0  # the first version still shows the other buckets
    versioned.upsert(spark, table, spark.createDataFrame([(k, "z", 9) for k in range(1000)] + [(None, "z", 9)], SCHEMA), ["v"])
    assert versioned.drop_old_versions(spark, table) == 2
    assert {r.v for r in versioned.read(spark, table).collect()} == {9} and versioned.read(spark, table).count() == 1001


def _files(folder):
    folder = folder.removeprefix("file:")
    return [os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet")]


@pytest.mark.parametrize("dies_at", [0, 1, 7])
def test_killed_upsert_loses_nothing(spark, table, monkeypatch, dies_at):
    batch = spark.createDataFrame([(k, "q", 1) for k in range(500, 1500)], SCHEMA)
    real, done = versioned._point, []

    def dying(*args):
        if len(done) == dies_at:
            raise RuntimeError("killed")
        done.append(args)
        real(*args)

    monkeypatch.setattr(versioned, "_point", dying)
    with pytest.raises(RuntimeError):
        versioned.upsert(spark, table, batch, ["v"])
    spark.catalog.refreshTable(table)
    half = {r.k: r.v for r in versioned.read(spark, table).collect()}
    assert set(range(1000)) <= set(half)  # each key in its old or its new state
    monkeypatch.setattr(versioned, "_point", real)
    versioned.upsert(spark, table, batch, ["v"])
    got = {r.k: r.v for r in versioned.read(spark, table).collect()}
    assert got == {**{k: int(k is not None and k >= 500) for k in [None, *range(1000)]}, **{k: 1 for k in range(1000, 1500)}}


def test_batches_of_other_types_and_empty_ones(spark, table):
    before = rows(versioned.read(spark, table))
    assert versioned.upsert(spark, table, spark.createDataFrame([], SCHEMA), ["v"]) == []
    assert rows(versioned.read(spark, table)) == before
    narrow = spark.createDataFrame([(5, "n", 4, "extra")], "k int, part string, v int, other string")
    versioned.upsert(spark, table, narrow, ["v"])
    assert (5, "n", 4) in rows(versioned.read(spark, table)) and versioned.read(spark, table).count() == len(before)


# -- sorted targets --------------------------------------------------------------


def scanned_rows(df) -> int:
    """Rows that the scan of ``df`` hands on."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frame = df._jdf
        frame.collectToPython()
        return frame.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()
    finally:
        df.sparkSession.conf.unset("spark.sql.adaptive.enabled")


def test_scan_falls_with_the_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(200_000).selectExpr("id * 3 AS k", "concat('p', id % 3) AS part", "0 AS v")
    load_sorted(base.repartition(8), path, ["k"], partition_by=["part"])
    target = read_as(base, path)
    assert scanned_rows(target) == 200_000
    near = spark.range(50).selectExpr("id + 30000 AS k", "'new' AS part", "1 AS v")
    two = near.unionAll(spark.range(50).selectExpr("id + 590000 AS k", "'new' AS part", "1 AS v"))
    assert scanned_rows(in_key_ranges(target, near, "k")) <= 0.35 * 200_000
    assert scanned_rows(in_key_ranges(target, two, "k")) <= 0.65 * 200_000
    plain = absent_rows(target, two, ["k"], ["v"])
    assert rows(absent_rows(in_key_ranges(target, two, "k"), two, ["k"], ["v"])) == rows(plain)
    insert_sorted(two, path, ["k"], ["v"], ["part"])
    insert_sorted(two, path, ["k"], ["v"], ["part"])
    assert read_as(base, path).count() == 200_000 + plain.count()


@pytest.mark.parametrize("kind", ["string", "double", "date", "timestamp", "decimal(10,2)"])
def test_key_types_null_and_hot_keys(spark, tmp_path, kind):
    day = "date_add(date'2024-01-01', cast(id as int))" if kind in ("date", "timestamp") else "id"
    base = spark.range(300).selectExpr(f"CAST({day} AS {kind}) AS k", "0 AS v")
    base = base.unionAll(base.where("false")).unionAll(spark.sql(f"SELECT CAST(NULL AS {kind}) AS k, 0 AS v"))
    path = str(tmp_path / "t")
    load_sorted(base, path, ["k"])
    batch = spark.range(250, 350).selectExpr(f"CAST({day} AS {kind}) AS k", "1 AS v")
    batch = batch.unionAll(batch).unionAll(spark.sql(f"SELECT CAST(NULL AS {kind}) AS k, 1 AS v"))
    insert_sorted(batch, path, ["k"], ["v"])
    assert read_as(base, path).groupBy("v").count().orderBy("v").collect() == [(0, 301), (1, 50)]


def test_empty_batch_and_first_load(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = spark.createDataFrame([], SCHEMA)
    insert_sorted(empty, path, ["k"], ["v"])
    insert_sorted(spark.createDataFrame([(1, "a", 2), (1, "a", 1)], SCHEMA), path, ["k"], ["v"])
    insert_sorted(empty, path, ["k"], ["v"])
    assert rows(read_as(empty, path)) == [(1, "a", 1)]
