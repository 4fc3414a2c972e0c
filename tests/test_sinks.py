import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from starloom.schemas import MUSIC_STAR, contract
from starloom.sinks import layout, loads
from starloom.sources import files


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def path(tmp_path):
    return str(tmp_path / "t")


def frame(spark, data):
    return spark.createDataFrame(data, "k int, m int, v string")


def test_default_mode_refuses_an_existing_table(spark, path):
    df = frame(spark, [(1, 1, "a")])
    loads.load(df, path)
    with pytest.raises(AnalysisException):
        loads.load(df, path)


def test_append_overwrite_and_unknown_mode(spark, path):
    df = frame(spark, [(1, 1, "a")])
    loads.load(df, path, partition_by=["m"])
    loads.load(df, path, "append", ["m"])
    assert spark.read.parquet(path).count() == 2
    # overwrite drops partitions that the new rows do not have
    loads.load(frame(spark, [(2, 2, "b")]), path, "overwrite", ["m"])
    assert rows(spark.read.parquet(path).select("k", "m", "v")) == [(2, 2, "b")]
    with pytest.raises(ValueError):
        loads.load(df, path, "replace")


def test_load_query_fills_columns_by_position(spark, path):
    frame(spark, [(1, 2, "a")]).createOrReplaceTempView("staged")
    schema = contract("id bigint, label string")
    for mode, expected in (("append", 1), ("append", 2), ("overwrite", 1)):
        table = loads.load_query(spark, "SELECT k, v FROM staged", path, schema, mode)
        assert rows(table) == [(1, "a")] * expected
    with pytest.raises(ValueError):
        loads.load_query(spark, "SELECT k FROM staged", path, schema)
    with pytest.raises(ValueError):
        loads.load_query(spark, "SELECT k, v FROM staged", path, schema, "merge")


def test_replace_partitions_leaves_the_others(spark, path):
    loads.load(frame(spark, [(1, 1, "a"), (2, 2, "b")]), path, partition_by=["m"])
    loads.replace_partitions(frame(spark, [(9, 2, "z")]), path, ["m"])
    assert rows(spark.read.parquet(path).select("k", "m", "v")) == [(1, 1, "a"), (9, 2, "z")]


@pytest.mark.parametrize("partition_by, keys", [(None, ["k"]), (["m"], ["k", "m"])])
def test_insert_if_absent_is_idempotent(spark, path, partition_by, keys):
    first = frame(spark, [(1, 1, "b"), (1, 1, "a"), (2, 2, "x")])
    loads.insert_if_absent(first, path, keys, ["v"], partition_by)
    second = frame(spark, [(1, 1, "0"), (3, 2, "n")])
    for _ in range(2):
        loads.insert_if_absent(second, path, keys, ["v"], partition_by)
    table = spark.read.parquet(path).select("k", "m", "v")
    assert rows(table) == [(1, 1, "a"), (2, 2, "x"), (3, 2, "n")]


@pytest.mark.parametrize("partition_by, keys", [(None, ["k"]), (["m"], ["k", "m"])])
def test_upsert_last_write_wins(spark, path, partition_by, keys):
    loads.upsert(frame(spark, [(1, 1, "a"), (2, 2, "x"), (4, 3, "stay")]), path, keys, ["v"], partition_by)
    batch = frame(spark, [(1, 1, "c"), (1, 1, "b"), (5, 2, "new")])
    for _ in range(2):
        loads.upsert(batch, path, keys, ["v"], partition_by)
    table = spark.read.parquet(path).select("k", "m", "v")
    assert rows(table) == [(1, 1, "c"), (2, 2, "x"), (4, 3, "stay"), (5, 2, "new")]


def test_only_touched_partitions_are_read(spark, path):
    loads.load(frame(spark, [(1, 1, "a"), (2, 2, "b")]), path, partition_by=["m"])
    target = spark.read.parquet(path)
    touched = loads._touched(target, frame(spark, [(7, 2, "q")]), ["m"])
    plan = touched._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters"):].splitlines()[0]
    assert "m#" in pruned and rows(touched.select("k")) == [(2,)]


def test_few_files_per_partition(spark, path, tmp_path):
    df = spark.range(1000, numPartitions=16).select("id", (F.col("id") % 2).alias("m"))
    loads.load(df, path, partition_by=["m"])
    assert len(list((tmp_path / "t").glob("m=*/*.parquet"))) == 2


def test_quoted_csv(spark, path, tmp_path):
    values = [('a,b "c" \\', 1)]
    loads.export_csv(spark.createDataFrame(values, "s string, i int").coalesce(1), path)
    text = next((tmp_path / "t").glob("*.csv")).read_text()
    assert text == '"s","i"\n"a,b ""c"" \\","1"\n'
    assert rows(files.read_csv(spark, path, schema=contract("s string, i int"))) == values


def test_land_raw_cleans_headers(spark, tmp_path):
    loads.land_raw({"x": spark.createDataFrame([(1,)], "`a b-c` int")}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "raw" / "x")).columns == ["a_b_c"]
    assert set(loads.check_table_set(spark, str(tmp_path / "raw"))) == {"x"}


def test_lookup_layout_pushes_the_key_and_sorts(spark, path):
    df = spark.range(10_000, numPartitions=4).select((F.col("id") * 17 % 100).alias("k"), F.col("id").alias("c"))
    layout.write_lookup(df, path, ["k"], ["c"])
    found = spark.read.parquet(path).where("k = 40")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,40)" in plan
    # files cover disjoint key ranges: the key lies in one or two of them
    assert found.select(F.input_file_name()).distinct().count() <= 2
    assert found.count() == 100


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    for name in ("plays_b", "artists_b"):
        df = spark.range(100).select(F.col("id").alias("k"), F.lit(name).alias(name))
        layout.write_bucketed(df, name, str(tmp_path / name), ["k"], ["k"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("plays_b").join(spark.table("artists_b"), "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("plays_b", "artists_b"):
            layout.drop_table(spark, name)


def test_create_and_drop_twice(spark, path):
    for _ in range(2):
        layout.create_table(spark, "declared", contract("a int, b string"), path)
    assert spark.table("declared").dtypes == [("a", "int"), ("b", "string")]
    for _ in range(2):
        layout.drop_table(spark, "declared")


def test_create_and_drop_a_schema(spark, path):
    star = {f"star_{name}": schema for name, schema in MUSIC_STAR.items()}
    for _ in range(2):
        layout.create_tables(spark, star, path)
    assert spark.table("star_users").columns == MUSIC_STAR["users"].names
    assert spark.table("star_songplays").count() == 0
    layout.drop_tables(spark, list(star))
    assert not spark.catalog.tableExists("star_users")


def test_views(spark):
    layout.register_views({"v_one": spark.range(3)})
    assert spark.sql("SELECT count(*) FROM v_one").collect()[0][0] == 3
