import pytest
from pyspark.sql import functions as F

from starloom.operators import joins


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def sides(spark):
    """One hot key with copies, one key on both sides twice, NULL keys, unmatched keys."""
    left = [("hot", 1, i % 3) for i in range(300)] + [("two", 2, 7), ("two", 2, 8)]
    left += [(None, 1, i) for i in range(20)] + [("none", None, 3), ("miss", 9, 1)]
    right = [("hot", 1, "h"), ("two", 2, "a"), ("two", 2, "b"), (None, 1, "n"), ("other", 3, "o")]
    return (
        spark.createDataFrame(left, "k string, j int, v int"),
        spark.createDataFrame(right, "k string, j int, w string"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("on", [["k"], ["k", "j"]])
def test_sliced_join_equals_plain_join(sides, how, on):
    left, right = sides
    right = right.select(*on, "w")
    plain = left.join(right, on, how)
    sliced = joins.sliced_join(left, right, on, how, hot_rows=10).select(*plain.columns)
    assert rows(sliced) == rows(plain)


def test_sliced_join_spreads_the_hot_key(spark):
    left = spark.range(10_000, numPartitions=4).select((F.col("id") % 2 * F.col("id")).alias("k"), "id")
    right = left.select("k").distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.sliced_join(left, right, ["k"], hot_rows=100)
        per_task = joined.where("k = 0").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in per_task) == 5000
    assert len(per_task) == 4 and max(r["count"] for r in per_task) < 2500


def test_a_key_hot_on_both_sides_spreads(spark):
    left = spark.range(600, numPartitions=4).select(F.lit("hot").alias("k"), "id")
    right = spark.range(400, numPartitions=4).select(F.lit("hot").alias("k"), F.col("id").alias("other"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.sliced_join(left, right, ["k"], hot_rows=50)
        per_task = joined.groupBy(F.spark_partition_id()).count().collect()
        assert joined.distinct().count() == 600 * 400
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in per_task) == 600 * 400
    assert len(per_task) == 4 and max(r["count"] for r in per_task) < 600 * 400 / 2


def test_sliced_join_refuses_joins_that_keep_right_rows(sides):
    with pytest.raises(ValueError):
        joins.sliced_join(*sides, ["k"], "full")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dim_join_broadcasts_only_below_the_checked_size(spark):
    fact = spark.range(1000).select((F.col("id") % 20).alias("k"), "id")
    small = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("label"))
    assert joins.estimated_bytes(small) < 10_000
    assert "BroadcastHashJoin [k" in plan_of(joins.dim_join(fact, small, ["k"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = plan_of(joins.dim_join(fact, small, ["k"], broadcast_bytes=1))
        sliced = plan_of(joins.dim_join(fact, small, ["k"], broadcast_bytes=1, hot_rows=9))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # without hot keys nothing is left of the slices
    assert "SortMergeJoin [k" in plain and "_left" not in plain
    assert "_left" in sliced


def test_code_join_compares_numbers_with_text(spark):
    fact = spark.createDataFrame([(1, 582.0), (2, 7.0), (3, None), (4, 582.5)], "id int, code double")
    codes = spark.createDataFrame([("582", "mexico"), ("007", "bond"), ("xx", "none")], "c string, label string")
    joined = joins.code_join(fact, codes, "code", "c")
    assert rows(joined) == [(1, 582.0, "mexico"), (2, 7.0, "bond")]


def test_label_join_equals_a_join_with_the_list(spark):
    fact = spark.createDataFrame([(1, 1.0), (2, 9.0), (3, 4.0), (4, None), (5, 1.5)], "id int, code double")
    labelled = joins.label_join(fact, {1: "Air", 9: "Not reported"}, "code", "mode")
    assert rows(labelled) == [(1, 1.0, "Air"), (2, 9.0, "Not reported")]


def test_role_join_labels_each_role_and_drops_unknown_codes(spark):
    fact = spark.createDataFrame([(1, 10.0, 20.0), (2, 10.0, 99.0), (3, None, 10.0)], "id int, a double, b double")
    codes = spark.createDataFrame([("10", "ten"), ("20", "twenty")], "c string, label string")
    joined = joins.role_join(fact, codes, {"a": "a_name", "b": "b_name"}, "c", "label")
    assert rows(joined) == [(1, 10.0, 20.0, "ten", "twenty")]


def test_name_join_ignores_case(spark):
    left = spark.createDataFrame([("MEXICO", 1), ("Peru", 2)], "a string, x int")
    right = spark.createDataFrame([("Mexico", 5), ("Chile", 6)], "b string, y int")
    assert rows(joins.name_join(left, right, "a", "b")) == [("MEXICO", 1, "Mexico", 5)]
