import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom import schemas
from starloom.plans import music, reports

MS = 1541121934000  # 2018-11-02 01:25:34


@pytest.fixture(scope="module")
def log(spark):
    """One exact match, a title-only match, a title with two songs, a miss, a repeated play, a visitor."""
    columns = "page string, ts bigint, userId int, firstName string, lastName string, gender string, level string, " \
        "song string, artist string, length double, sessionId int, location string, userAgent string"
    who = (7, "Ann", "Lee", "F")
    rows = [
        ("NextSong", MS, *who, "free", "One", "Band", 200.4, 1, "X, CA", 'ua "1"'),
        ("NextSong", MS + 100, *who, "paid", "One", "Cover", 99.0, 1, "X, CA", "ua"),
        ("NextSong", MS + 2000, *who, "paid", "Two", "Duo", 150.0, 1, "X, CA", "ua"),
        ("NextSong", MS + 3000, *who, "paid", "None", "Nobody", 1.0, 1, "X, CA", "ua"),
        ("NextSong", MS + 3000, *who, "paid", "None", "Nobody", 1.0, 1, "X, CA", "ua"),
        ("NextSong", MS + 4000, None, None, None, None, "free", "One", "Band", 200.4, 2, None, "ua"),
        ("Home", MS + 7200000, 8, "Bob", "Kay", "M", "free", None, None, None, 3, None, "ua"),
        ("Login", MS + 7200000, None, None, None, None, "free", None, None, None, 4, None, None),
    ]
    return spark.createDataFrame(rows, columns)


@pytest.fixture(scope="module")
def songs(spark):
    rows = [
        (1, "A1", 1.5, None, None, "Band", "S1", "One", 200.4, 2000),
        (1, "A2", None, None, "Rome", "Duo", "S2", "Two", 150.0, 0),
        (1, "A2", 3.0, 4.0, "Rome", "Duo", "S3", "Two", 150.0, 0),
        (1, "A3", None, None, None, "Rest", "S4", None, 1.0, 0),
        (1, "A1", 1.5, None, None, "Band", "S1", "One", 200.4, 2000),
    ]
    names = "num_songs int, artist_id string, artist_latitude double, artist_longitude double, artist_location string, " \
        "artist_name string, song_id string, title string, duration double, year int"
    return spark.createDataFrame(rows, names)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_typed_log_reads_ids(spark):
    raw = spark.createDataFrame([("", 1.5e12), ("26", None), ("x", None)], "userId string, registration double")
    assert rows(music.typed_log(raw)) == [(26, None), (None, 1500000000000), (None, None)]


def test_users(log):
    plays = music.plays(log)
    assert rows(music.users_dim(plays).select("user_id", "level")) == [(7, "free"), (7, "paid")]
    assert rows(music.users_dim(log).select("user_id", "level")) == [(7, "free"), (7, "paid"), (8, "free")]
    assert rows(music.users_dim(plays, "first_seen")) == [(7, "Ann", "Lee", "F", "free")]
    with pytest.raises(ValueError):
        music.users_dim(log, "other")


def test_songs_and_artists(songs):
    assert music.songs_dim(songs, "all").count() == 5
    assert music.songs_dim(songs).count() == 4
    assert rows(music.artists_dim(songs, "first").select("artist_id", "latitude")) == [
        ("A1", 1.5), ("A2", None), ("A3", None),
    ]
    filled = music.artists_dim(songs, defaults=True)
    assert ("A3", "Rest", "NaN", 0.0, 0.0) in rows(filled)
    with pytest.raises(ValueError):
        music.songs_dim(songs, "other")


def test_time_variants(log):
    seconds = music.time_dim(music.plays(log), F.timestamp_seconds(F.floor(F.col("ts") / 1000)))
    assert seconds.count() == 4
    assert rows(seconds.select("hour", "day", "week", "month", "year", "weekday"))[0] == (1, 2, 44, 11, 2018, 4)
    hours = F.date_trunc("hour", F.timestamp_millis("ts"))
    assert rows(music.time_dim(log, hours, "sunday0").select("hour", "weekday")) == [(1, 5), (3, 5)]
    repeated = music.time_dim(log, hours, "name", distinct=False)
    assert repeated.count() == 8 and repeated.first()["weekday"] == "Friday"


def test_keyed_fact_keeps_every_play_once(log, songs):
    fact = music.songplays_keyed(log, music.songs_dim(songs, "first"), music.artists_dim(songs, "first"))
    got = rows(fact.select("start_time", "user_id", "song_id", "artist_id"))
    base = dt.datetime(2018, 11, 2, 1, 25, 34)
    assert sorted(got, key=lambda r: r[0]) == [
        (base, 7, "S1", "A1"),
        (base + dt.timedelta(milliseconds=100), 7, None, None),
        (base + dt.timedelta(seconds=2), 7, "S2", "A2"),
        (base + dt.timedelta(seconds=3), 7, None, None),
        (base + dt.timedelta(seconds=4), None, "S1", "A1"),
    ]


def test_warehouse_fact_matches_titles_at_hour_grain(log, songs):
    fact = music.songplays_warehouse(log, music.songs_dim(songs))
    assert set(fact.columns) == set(schemas.SONGPLAYS.names) - {"songplay_id"}
    assert rows(fact.select("user_id", "song_id")) == [
        (7, "S1"), (7, "S1"), (7, "S2"), (7, "S3"), (None, "S1"),
    ]
    assert {r["start_time"] for r in fact.collect()} == {dt.datetime(2018, 11, 2, 1)}


def test_lake_fact_repeats_per_artist_row(log, songs):
    song_dim, artist_dim = music.songs_dim(songs), music.artists_dim(songs, "all")
    fact = music.songplays_lake(log, song_dim, artist_dim)
    # S1 meets two rows of A1, S2 and S3 each meet two rows of A2
    assert fact.count() == 3 * 2 + 2 * 2
    assert fact.first()["start_time"].startswith("2018-11-02 01:25:3")
    assert music.songplays_lake(log, song_dim, artist_dim, one_per_artist=True).count() == 5


def test_strict_fact_and_its_key(log, songs):
    fact = music.songplays_strict(log, songs)
    assert fact.columns == schemas.SONGPLAYS.names
    got = rows(fact.select("user_id", "song_id"))
    # the song row S1 is there twice, so its plays are too
    assert got == [(-1, "S1"), (-1, "S1"), (7, "S1"), (7, "S1"), (7, "S2"), (7, "S3")]
    assert fact.select("songplay_id").distinct().count() == 3


def test_facts_are_the_same_whether_sliced_or_broadcast(log, songs, monkeypatch):
    song_dim, artist_dim = music.songs_dim(songs, "first"), music.artists_dim(songs, "first")

    def all_facts():
        return [
            rows(music.songplays_keyed(log, song_dim, artist_dim, hot_rows=1)),
            rows(music.songplays_warehouse(log, song_dim, hot_rows=1)),
            rows(music.songplays_lake(log, song_dim, artist_dim, hot_rows=1)),
            rows(music.songplays_strict(log, songs, hot_rows=1)),
        ]

    broadcast = all_facts()
    monkeypatch.setattr("starloom.operators.joins.dim_join.__defaults__", ("inner", -1, 1, None, None))
    assert all_facts() == broadcast


def test_report_counts_distinct_songs_and_artists(spark):
    plays = spark.createDataFrame(
        [(1, "S1", "A1", 0), (1, "S1", "A1", 0), (1, "S2", "A1", 0), (2, "S1", "A1", 0), (1, "S9", "A1", 0),
         (1, "S3", "A9", 0), (1, "S3", "A2", 40), (3, None, None, 0)],
        "user_id int, song_id string, artist_id string, d int",
    ).withColumn("start_time", F.expr("timestamp'2018-11-02 01:00:00' + make_dt_interval(d)"))
    users = spark.createDataFrame([(1, "Lee", "free"), (1, "Lee", "paid"), (2, "Kay", "free")], "user_id int, last_name string, level string")
    songs = spark.createDataFrame([("S1",), ("S2",), ("S2",), ("S3",)], "song_id string")
    artists = spark.createDataFrame([("A1",), ("A1",), ("A2",)], "artist_id string")
    time = music.time_dim(plays, F.col("start_time"))
    report = reports.plays_by_user(plays, users, songs, artists, time, 11)
    expected = [(1, "Lee", 2, 1), (2, "Kay", 1, 1)]
    assert [tuple(r) for r in report.collect()] == expected
    for name, df in (("songplays", plays), ("users", users), ("songs", songs), ("artists", artists), ("time", time)):
        df.createOrReplaceTempView(name)
    assert [tuple(r) for r in spark.sql(reports.PLAYS_BY_USER_SQL.format(month=11)).collect()] == expected
