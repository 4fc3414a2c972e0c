"""Aggregates kept with the load, against the facts they stand for."""

import random

import pytest
from pyspark.sql import functions as F

from starloom.operators.frames import pivot_map, pivot_sum
from starloom.plans import reports, rollups


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def arrivals(spark):
    rng = random.Random(1)
    data = [
        (2016, m, f"2016-{m:02d}-{rng.randint(1, 28):02d}", rng.choice(["NYC", "MIA", "LAX", None]), i)
        for i, m in enumerate(rng.choices([1, 2, 3], k=600))
    ]
    fact = spark.createDataFrame(data, "i94yr int, i94mon int, day string, i94port string, cicid int")
    fact = fact.withColumn("arrdate_ts", F.col("day").cast("date")).drop("day")
    dates = fact.select(F.col("arrdate_ts").alias("date")).distinct().withColumn("weekday", F.weekday("date"))
    cities = spark.createDataFrame([("NYC", "NY"), ("MIA", "FL"), ("TPA", "FL")], "city_id string, state_code string")
    return fact, dates, cities


def test_report_from_kept_counts(spark, arrivals, tmp_path):
    fact, dates, cities = arrivals
    daily = rollups.keep_daily_arrivals(fact, str(tmp_path / "d"))
    for state in ("NY", "FL", "ZZ"):
        expected = reports.arrivals_by_weekday(fact, dates, cities, state)
        assert rollups.weekdays_of_daily(daily, dates, cities, state).collect() == expected.collect()


def test_reload_changes_its_month_alone(spark, arrivals, tmp_path):
    fact, dates, cities = arrivals
    path = str(tmp_path / "d")
    rollups.keep_daily_arrivals(fact, path)
    files = {f for f in (tmp_path / "d").rglob("*.parquet") if "i94mon=2" not in str(f)}
    less = fact.where("i94mon = 2 AND cicid % 3 = 0")
    daily = rollups.keep_daily_arrivals(less, path)
    assert {f for f in (tmp_path / "d").rglob("*.parquet") if "i94mon=2" not in str(f)} == files
    left = fact.where("i94mon <> 2 OR cicid % 3 = 0")
    assert rows(daily) == rows(rollups.daily_arrivals(left).select(*daily.columns))
    assert rollups.keep_daily_arrivals(fact.limit(0), path).count() == daily.count()


@pytest.fixture(scope="module")
def music(spark):
    rng = random.Random(2)
    data = [
        (rng.choice([1, 2, 3, None]), rng.choice([f"S{i}" for i in range(70)] + [None]), f"A{rng.randint(0, 9)}", month)
        for month in rng.choices(range(1, 7), k=900)
    ]
    plays = spark.createDataFrame(data, "user_id int, song_id string, artist_id string, month int")
    users = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b2"), (4, "d")], "user_id int, last_name string")
    return plays, users


def brute(plays, users, first, last):
    heard = plays.where(F.col("month").between(first, last)).where("user_id is not null")
    per = heard.groupBy("user_id").agg(F.countDistinct("song_id").alias("s"), F.countDistinct("artist_id").alias("a"))
    return rows(per.join(users, "user_id").select("user_id", "last_name", "s", "a"))


def numbered(spark, plays, root):
    return {key: rollups.number_keys(plays, f"{root}/{key}", key) for key in rollups.HEARD}


def test_bitmaps_equal_distinct_counts_over_any_range(spark, music, tmp_path):
    plays, users = music
    kept = rollups.keep_listening(plays, numbered(spark, plays, tmp_path), F.col("month"), str(tmp_path / "bits"))
    for first, last in ((1, 6), (2, 4), (3, 3), (6, 5)):
        assert rows(rollups.heard_by_user(kept, users, first, last)) == brute(plays, users, first, last)
    plan = rollups.heard_by_user(kept, users, 2, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "period" in plan[plan.index("PartitionFilters") :].splitlines()[0]


def test_new_songs_keep_old_numbers_and_periods_are_replaced(spark, music, tmp_path):
    plays, users = music
    early = plays.where("month <= 3")
    first = rows(numbered(spark, early, tmp_path)["song_id"])
    path = str(tmp_path / "bits")
    rollups.keep_listening(early, numbered(spark, early, tmp_path), F.col("month"), path)
    numbers = numbered(spark, plays, tmp_path)
    after = rows(numbers["song_id"])
    assert set(first) <= set(after) and sorted(n for _, n in after) == list(range(1, len(after) + 1))
    late = plays.where("month >= 3")
    for _ in range(2):
        kept = rollups.keep_listening(late, numbers, F.col("month"), path)
    assert rows(rollups.heard_by_user(kept, users, 1, 6)) == brute(plays, users, 1, 6)


def test_numbers_beyond_one_bitmap(spark, tmp_path):
    plays = spark.range(100_000).selectExpr("1 AS user_id", "concat('s', id) AS song_id", "'a' AS artist_id", "1 AS month")
    users = spark.createDataFrame([(1, "x")], "user_id int, last_name string")
    kept = rollups.keep_listening(plays, numbered(spark, plays, tmp_path), F.col("month"), str(tmp_path / "bits"))
    assert rows(rollups.heard_by_user(kept, users, 1, 1)) == [(1, "x", 100_000, 1)]
    assert kept.where("kind = 'song_id'").count() == 4


def test_bitmaps_take_what_was_heard(spark, tmp_path):
    songs = spark.range(40_000).selectExpr("concat('s', id) AS song_id", "'a' AS artist_id")
    numbers = numbered(spark, songs, tmp_path)
    plays = songs.where("substr(song_id, -3) = '123'").selectExpr(
        "cast(substr(song_id, 2) as int) % 7 AS user_id", "*", "1 AS month"
    )
    kept = rollups.keep_listening(plays, numbers, F.col("month"), str(tmp_path / "bits"))
    per_user = kept.selectExpr("user_id", "octet_length(to_json(struct(*))) AS size").groupBy("user_id").sum("size")
    assert max(r[1] for r in per_user.collect()) < 2000
    users = plays.selectExpr("user_id", "'x' AS last_name").distinct()
    assert rows(rollups.heard_by_user(kept, users, 1, 1)) == brute(plays, users, 1, 1)
    # no aggregate sorts its state
    for made in (rollups.listening(plays, numbers, F.col("month")), rollups.heard_by_user(kept, users, 1, 1)):
        assert "SortAggregate" not in made._jdf.queryExecution().executedPlan().toString()


def test_every_place_of_a_bitmap_counts_once(spark, tmp_path):
    plays = spark.range(70_000).selectExpr(
        "id % 2 AS user_id", "concat('s', lpad(id, 6, '0')) AS song_id", "'a' AS artist_id", "id % 3 AS month"
    )
    numbers = numbered(spark, plays, tmp_path)
    edges = numbers["song_id"].where("number IN (1, 63, 64, 65, 128, 32767, 32768, 32769, 65536, 65537)").select("song_id")
    few = plays.join(edges, "song_id").select(*plays.columns)
    both = few.unionByName(few.withColumn("month", F.lit(7)))
    users = spark.createDataFrame([(0, "x"), (1, "y")], "user_id int, last_name string")
    kept = rollups.keep_listening(both, numbers, F.col("month"), str(tmp_path / "bits"))
    for first, last in ((0, 7), (0, 1), (7, 7)):
        assert rows(rollups.heard_by_user(kept, users, first, last)) == brute(both, users, first, last)


def test_pivot_map_equals_the_pivot(spark):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "x", 2), ("a", None, 5), ("b", "y", 7), ("b", "z", None)], "k string, p string, v int"
    )
    expected = {
        r["k"]: {c: r[c] for c in r.asDict() if c != "k" and r[c] is not None} for r in pivot_sum(df, ["k"], "p", "v").collect()
    }
    assert {r["k"]: r["sums"] for r in pivot_map(df, ["k"], "p", "v").collect()} == expected
    assert pivot_map(df.limit(0), ["k"], "p", "v").count() == 0


def test_pivot_map_takes_any_number_of_values(spark):
    df = spark.range(60_000).selectExpr("id % 2 AS k", "id % 20000 AS p", "1 AS v")
    found = pivot_map(df, ["k"], "p", "v").select("k", F.size("sums").alias("n"), F.expr("sums['19998']").alias("one"))
    assert rows(found) == [(0, 10_000, 3), (1, 10_000, None)]
