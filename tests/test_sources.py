import json

import pytest
from pyspark.sql import functions as F

from starloom import schemas
from starloom.sources import files, staging


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_read_logs_and_malformed_line(spark, tmp_path):
    line = {"page": "NextSong", "ts": 1, "userId": "7", "registration": 1540919166796.0, "userAgent": 'a "q" b'}
    write(tmp_path / "d1.json", json.dumps(line) + "\n{broken\n")
    write(tmp_path / "d2.json", json.dumps({"page": "Home", "ts": 2, "userId": ""}))
    log = files.read_logs(spark, str(tmp_path))
    assert log.schema == schemas.ACTIVITY_LOG
    got = rows(log.select("page", "userId", "userAgent"))
    assert got == [("Home", "", None), ("NextSong", "7", 'a "q" b'), (None, None, None)]


def test_read_songs_at_any_depth(spark, tmp_path):
    for i, folder in enumerate(("A/B/C", "A/B/D", "E")):
        write(tmp_path / folder / f"s{i}.json", json.dumps({"song_id": f"S{i}", "year": 0}))
    write(tmp_path / "A" / "note.txt", "{}")
    assert rows(files.read_songs(spark, str(tmp_path)).select("song_id", "year")) == [("S0", 0), ("S1", 0), ("S2", 0)]


def test_first_record_per_file(spark, tmp_path):
    write(tmp_path / "a.json", '{"song_id": "z"}\n{"song_id": "a"}\n')
    write(tmp_path / "b.json", '{"song_id": "m"}\n')
    songs = files.read_songs(spark, str(tmp_path))
    assert rows(files.first_record_per_file(songs).select("song_id")) == [("m",), ("z",)]


def test_csv_separators(spark, tmp_path):
    write(tmp_path / "c.csv", "State Code;Count\nCA;5\n;6\n")
    df = files.read_csv(spark, str(tmp_path / "c.csv"), sep=";")
    assert df.columns == ["State Code", "Count"]
    assert rows(df) == [("CA", "5"), (None, "6")]


EVENT_HEADER = (
    "artist,auth,firstName,gender,itemInSession,lastName,length,level,location,method,page,"
    "registration,sessionId,song,status,ts,userId\n"
)


def event(artist, item, session, song, user, first="Ann"):
    return f'{artist},in,{first},F,{item},Lee,200.5,free,"Yuba City, CA",PUT,NextSong,1.5E+12,{session},{song},200,1.5E+12,{user}\n'


def test_event_csvs(spark, tmp_path):
    write(tmp_path / "1.csv", EVENT_HEADER + event("Band", 0, 9, "Tune", 4) + event("", 1, 9, "", 4))
    write(tmp_path / "2.csv", EVENT_HEADER + event("Duo", 2, 9, "It's", 4))
    df = files.read_event_csvs(spark, str(tmp_path))
    assert df.columns == schemas.EVENT_CSV_KEPT
    assert rows(df.select("artist", "itemInSession", "location", "song")) == [
        ("Band", 0, "Yuba City, CA", "Tune"), ("Duo", 2, "Yuba City, CA", "It's"),
    ]


def test_texts_and_restore(spark, tmp_path):
    write(tmp_path / "l.txt", "one\ntwo")
    assert files.read_texts(spark, str(tmp_path / "l.txt")).collect()[0]["value"] == "one\ntwo"
    for name, n in (("zeta", 1), ("alpha", 2)):
        spark.range(n).write.parquet(str(tmp_path / "root" / name))
    tables = files.restore_tables(spark, str(tmp_path / "root"))
    assert {name: df.count() for name, df in tables.items()} == {"alpha": 2, "zeta": 1}


def test_monthly_files_with_drifting_columns_and_types(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "i int, s string").write.parquet(str(tmp_path / "m1"))
    spark.createDataFrame([("2", 5.0)], "i string, extra double").write.parquet(str(tmp_path / "m2"))
    months = files.read_monthly(
        spark, [str(tmp_path / "m1"), str(tmp_path / "m2")], schemas.contract("i int, s string")
    )
    assert rows(months) == [(1, "a"), (2, None)]


LINES = ['{"k": 1, "more": {"x": "y"}, "z": 3}', '{"k": "bad"}', "{broken", '{"other": 1}']


@pytest.fixture()
def lines(spark):
    return spark.createDataFrame([(i, line) for i, line in enumerate(LINES)], "n int, value string")


def test_stage_by_name_and_path(lines):
    by_name = staging.stage_by_name(lines, "value", schemas.contract("z int, k int"), keep=["n"])
    assert rows(by_name) == [(0, 3, 1), (1, None, None), (2, None, None), (3, None, None)]
    by_path = staging.stage_by_path(lines, "value", ["$.more.x", "$.k"], schemas.contract("a string, b int"), ["n"])
    assert rows(by_path)[:2] == [(0, "y", 1), (1, None, None)]
    with pytest.raises(ValueError):
        staging.stage_by_path(lines, "value", ["$.k"], schemas.contract("a string, b int"))


def test_rejects_lose_no_row(lines):
    good, bad = staging.split_rejects(lines, "value", schemas.contract("k int"), keep=["n"])
    assert rows(good) == [(0, 1), (3, None)]
    assert rows(bad) == [(1, '{"k": "bad"}'), (2, "{broken")]


def test_rejects_of_files(spark, tmp_path):
    write(tmp_path / "x.json", "\n".join(LINES))
    good, bad = staging.stage_with_rejects(spark, str(tmp_path), schemas.contract("k int"))
    assert (good.count(), bad.count()) == (2, 2)


def test_month_filter_reaches_the_scan(spark, tmp_path):
    spark.sql(
        "SELECT explode(sequence(timestamp_ntz'2024-01-30', timestamp_ntz'2024-03-02', interval 1 day)) AS ts"
    ).write.parquet(str(tmp_path / "t"))
    month = staging.of_month(spark.read.parquet(str(tmp_path / "t")), "ts", "2024-02-11")
    assert month.count() == 29
    plan = month._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].splitlines()[0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_month_path():
    assert staging.month_path("s3a://b/log_data/{year}/{month}/", "2018-11-05") == "s3a://b/log_data/2018/11/"


def test_read_lines(spark, tmp_path):
    write(tmp_path / "x.json", "\n".join(LINES))
    assert staging.read_lines(spark, str(tmp_path)).select(F.col("value")).count() == 4
