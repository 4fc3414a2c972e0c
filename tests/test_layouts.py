"""One clustered copy for all lookups, and ids that several writers share."""

from concurrent.futures import ThreadPoolExecutor

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starloom.operators.keys import reserve_blocks, reserved_ids
from starloom.plans import lookups
from starloom.sinks import layout


@pytest.fixture(scope="module")
def copy(spark, tmp_path_factory):
    events = spark.range(120_000).selectExpr(
        "cast(pmod(hash(id), 3000) as int) AS sessionId",
        "cast(id % 50 as int) AS itemInSession",
        "concat('artist ', pmod(hash(id, 1), 500)) AS artist",
        "if(id % 97 = 0, NULL, concat('song ', pmod(hash(id, 2), 2000))) AS song",
        "cast(id as double) AS length",
        "cast(pmod(hash(id, 3), 1000) as int) AS userId",
        "concat('f', id % 9) AS firstName",
        "concat('l', id % 7) AS lastName",
        "id AS ts",
    )
    root = tmp_path_factory.mktemp("copy")
    lookups.build_one_copy(events, str(root / "one"), ["ts"], row_group=8 << 10)
    lookups.build_lookup_tables(events, str(root / "three"), ["ts"])
    return events, root


def skipped(path, **key) -> float:
    """Share of the row groups whose statistics exclude the key."""
    hit = total = 0
    for file in path.glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            stats = {c: meta.row_group(g).column(at[c]).statistics for c in key}
            hit += all(s.has_min_max and s.min <= key[c] <= s.max for c, s in stats.items())
            total += 1
    return 1 - hit / total


@pytest.mark.parametrize("seed", range(4))
def test_each_lookup_skips_most_row_groups(copy, seed):
    _, root = copy
    one = root / "one"
    assert skipped(one, sessionId=700 * seed + 31) >= 0.8
    assert skipped(one, userId=230 * seed + 5, sessionId=700 * seed + 31) >= 0.95
    assert skipped(one, song=f"song {450 * seed + 17}") >= 0.8


def test_answers_equal_those_of_the_three_tables(spark, copy):
    events, root = copy
    one, three = str(root / "one"), str(root / "three")
    asked = events.where("song IS NOT NULL").orderBy(F.hash("ts")).limit(3).collect()
    for r in asked:
        play = lookups.find_in_copy(
            spark, one, "songInfo", ["artist", "song", "length"], ["ts"], sessionId=r.sessionId, itemInSession=r.itemInSession
        )
        assert play.collect() == lookups.play_in_session(spark, three, r.sessionId, r.itemInSession).collect()
        names = ["artist", "song", "firstName", "lastName"]
        session = lookups.find_in_copy(spark, one, "sessionInfo", names, ["ts"], userId=r.userId, sessionId=r.sessionId)
        assert session.collect() == lookups.plays_of_session(spark, three, r.userId, r.sessionId).collect()
        heard = lookups.find_in_copy(spark, one, "userInfo", ["song", "firstName", "lastName"], ["ts"], song=r.song)
        assert sorted(heard.collect()) == sorted(lookups.listeners_of_song(spark, three, r.song).collect())
    plan = session._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(userId,{r.userId})" in plan and f"EqualTo(sessionId,{r.sessionId})" in plan
    assert spark.read.parquet(one).count() == events.count()


def test_interleaved_bits(spark):
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    got = df.select("a", "b", layout.interleaved([F.col("a"), F.col("b")], 2).alias("z")).collect()
    for r in got:
        assert r.z == sum((r.a >> k & 1) << 2 * k | (r.b >> k & 1) << 2 * k + 1 for k in range(2))


@pytest.mark.parametrize("rows", [[], [(None,)] * 3, [("x",)] * 50, [(c,) for c in "hello"]])
def test_clustering_of_few_and_equal_values(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "c string")
    layout.write_clustered(df, str(tmp_path / "t"), ["c"])
    assert sorted(map(tuple, spark.read.schema("c string").parquet(str(tmp_path / "t")).collect()), key=repr) == sorted(rows, key=repr)


def test_blocks_are_reserved_once(spark, tmp_path):
    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(lambda n: reserve_blocks(spark, str(tmp_path / "ids"), n), [3, 1, 4, 1, 5, 2]))
    taken = [b for blocks in got for b in blocks]
    assert len(taken) == len(set(taken)) == 16 and list(map(len, got)) == [3, 1, 4, 1, 5, 2]
    assert reserve_blocks(spark, str(tmp_path / "ids"), 0) == []


def test_ids_of_concurrent_loads(spark, tmp_path):
    folder = str(tmp_path / "ids")

    def number(n):
        df = spark.range(n).selectExpr("id * 2 AS k", "'x' AS id2")
        return [tuple(r) for r in reserved_ids(df, ["k"], "id", folder, block=64).orderBy("k").collect()]

    with ThreadPoolExecutor(3) as pool:
        loads = list(pool.map(number, [200, 0, 130]))
    ids = [r[0] for rows in loads for r in rows]
    assert len(ids) == 330 == len(set(ids)) and min(ids) >= 1
    for rows in loads:
        assert [r[0] for r in rows] == sorted(r[0] for r in rows)
    again = number(10)
    assert not set(ids) & {r[0] for r in again}
