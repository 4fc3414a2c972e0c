import hashlib

from pyspark.sql import functions as F

from starloom.operators import clean, dedup, frames, keys, merge
from starloom.schemas import contract


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "n"), (None, 4, "k")], "k string, t int, v string"
    )
    assert rows(dedup.first_per_key(df, ["k"], ["t"])) == [("a", 1, "y"), ("b", None, "n"), (None, 4, "k")]
    assert rows(dedup.last_per_key(df, ["k"], ["t"])) == [("a", 2, "x"), ("b", None, "n"), (None, 4, "k")]


def test_dedup_is_an_aggregate_not_a_window(spark):
    df = spark.createDataFrame([(1, 2, 3)], "k int, t int, v int")
    plan = dedup.first_per_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan


def test_dense_ids_have_no_gaps_and_follow_the_order(spark):
    df = spark.range(5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("n"), F.lit("x").alias("x"))
    numbered = keys.dense_ids(df, ["n"], "id", start=1)
    assert numbered.where("id != n + 1").count() == 0
    assert numbered.count() == 5000


def test_dense_ids_of_equal_rows(spark):
    df = spark.range(3000, numPartitions=6).select(F.lit(1).alias("n"))
    ids = keys.dense_ids(df, ["n"], "id", start=0)
    assert rows(ids.agg(F.min("id"), F.max("id"), F.countDistinct("id"))) == [(0, 2999, 3000)]


def test_dense_ids_of_nothing(spark):
    assert keys.dense_ids(spark.range(0), ["id"], "n").count() == 0


def test_gap_ids_are_unique(spark):
    df = keys.gap_ids(spark.range(1000, numPartitions=5), "n")
    assert df.select("n").distinct().count() == 1000


def test_content_key(spark):
    df = spark.createDataFrame([(1, "b"), (None, "b")], "a int, b string")
    got = rows(df.select(keys.content_key(F.col("a"), F.col("b"))))
    assert got == [(hashlib.md5(b"1b").hexdigest(),), (None,)]


def test_outer_union_and_conform(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("2", 3.0), ("bad", 4.0)], "i string, d double")
    assert rows(frames.outer_union(a, b.select("d"))) == [(1, "x", None), (None, None, 3.0), (None, None, 4.0)]
    target = contract("i int, s string")
    assert rows(frames.conform(b, target)) == [(2, None), (None, None)]


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert rows(frames.null_profile(df)) == [("a", 1, 33.33), ("b", 2, 66.67)]
    assert rows(frames.null_profile(df.limit(0))) == [("a", 0, None), ("b", 0, None)]


def test_null_profile_reads_the_table_once(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    plan = frames.null_profile(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_duplicate_report(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 2), (None, 2)], "k string, j int")
    assert rows(frames.duplicate_report(df, ["k", "j"])) == [("a", 1, 2), (None, 2, 2)]


def test_pivot_then_rollup_counts_a_city_once(spark):
    df = spark.createDataFrame(
        [("CA", "x", 10, "White", 5), ("CA", "x", 10, "Asian", 2), ("CA", "y", 20, "White", 1)],
        "code string, city string, pop int, race string, n int",
    )
    wide = frames.pivot_sum(df, ["code", "city", "pop"], "race", "n")
    assert wide.columns == ["code", "city", "pop", "Asian", "White"]
    assert rows(frames.sum_numeric(wide, ["code"])) == [("CA", 30, 2, 6)]


def test_table_shape_and_top_n(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "a int, b string")
    assert rows(frames.table_shape({"t": df, "u": df.limit(0)})) == [("t", 3, 2), ("u", 0, 2)]
    top = frames.top_n(df, [F.desc("a")], 2)
    assert [r["a"] for r in top.collect()] == [3, 2]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_cleaning(spark):
    df = spark.createDataFrame([("1", None), ("x", 2.0)], "a string, b double")
    assert rows(clean.cast_columns(df, {"a": "int"})) == [(1, None), (None, 2.0)]
    assert rows(clean.default_for_null(df, {"b": 0.0})) == [("1", 0.0), ("x", 2.0)]
    days = spark.createDataFrame([(5, 6), (5, 1), (5, None)], "a int, d int")
    assert rows(clean.not_before(days, ["a", "d"], F.lit(5))) == [(5, 6)]
    ids = spark.createDataFrame([("s", "a"), ("None", "a"), ("s", None)], "s string, a string")
    assert rows(clean.matched_only(ids, ["s", "a"])) == [("s", "a")]


def test_absent_rows(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    batch = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, v string")
    assert rows(merge.absent_rows(target, batch, ["k"], ["v"])) == [(2, "a")]


def test_upserted(spark):
    target = spark.createDataFrame([(1, "old", 0), (3, "kept", 0)], "k int, v string, s int")
    batch = spark.createDataFrame([(1, "new", 2), (1, "mid", 1), (2, "b", 1)], "k int, v string, s int")
    merged = merge.upserted(target, batch, ["k"], ["s"])
    assert rows(merged) == [(1, "new", 2), (2, "b", 1), (3, "kept", 0)]
