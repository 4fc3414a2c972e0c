"""The end-to-end jobs on small hand-written files."""

import json

import pytest
from pyspark.errors import AnalysisException

from starloom.plans import jobs, lookups
from starloom.plans.quality import QualityError
from starloom.schemas import ACTIVITY_LOG, ARRIVALS, MUSIC_STAR
from starloom.streaming.hourly import run_hourly
from tests.test_arrivals import arrival
from tests.test_functions import LABELS
from tests.test_sources import EVENT_HEADER, event, write

MS = 1541121934796  # 2018-11-02 01:25:34.796


def play(ts, user="7", song="One", artist="Band", length=200.4, **more):
    record = dict(
        page="NextSong", ts=ts, userId=user, firstName="Ann", lastName="Lee", gender="F", level="free", song=song,
        artist=artist, length=length, sessionId=1, itemInSession=0, location="X, CA", userAgent="ua",
        registration=1540919166796.0,
    )
    return json.dumps({**record, **more})


def song(sid, aid, title, name, duration, year=0):
    return json.dumps(
        dict(num_songs=1, artist_id=aid, artist_name=name, artist_location="", artist_latitude=None,
             artist_longitude=None, song_id=sid, title=title, duration=duration, year=year)
    )


@pytest.fixture()
def music_files(tmp_path):
    logs = [
        play(MS), play(MS + 5000, song="Miss"), play(MS + 3600000, user="8", lastName="Kay", level="paid"),
        json.dumps(dict(page="Home", ts=MS + 9000, userId="", level="free")),
    ]
    write(tmp_path / "log/2018/11/d.json", "\n".join(logs))
    write(tmp_path / "song/A/A/A/1.json", song("S1", "A1", "One", "Band", 200.4, 2000))
    write(tmp_path / "song/A/A/B/2.json", song("S2", "A2", "One", "Cover", 99.0))
    return tmp_path


@pytest.mark.parametrize("rules, plays", [("keyed", 3), ("warehouse", 4), ("lake", 4), ("strict", 2)])
def test_music_star(spark, music_files, rules, plays):
    out = str(music_files / rules)
    args = (spark, str(music_files / "log/2018/11"), str(music_files / "song"), out, rules)
    tables = jobs.build_music_star(*args)
    assert set(tables) == set(MUSIC_STAR)
    for name, schema in MUSIC_STAR.items():
        assert set(schema.names) <= set(tables[name].columns), name
    assert tables["songplays"].count() == plays
    assert tables["songplays"].select("songplay_id").distinct().count() == plays
    report = {r["check"]: r["passed"] for r in jobs.music_quality(tables).collect()}
    assert len(report) == 14
    assert report["songplays.start_time refers to start_time"]
    assert report["songplays.user_id refers to user_id"] and report["songs key (song_id) is unique"]
    with pytest.raises(AnalysisException):
        jobs.build_music_star(*args)
    again = jobs.build_music_star(*args, mode="overwrite")
    assert again["songplays"].count() == plays


def test_song_staged_twice_repeats_its_plays_under_the_warehouse_rules(spark, music_files):
    write(music_files / "song/A/A/A/again.json", song("S1", "A1", "One", "Band", 200.4, 2000))
    args = (spark, str(music_files / "log/2018/11"), str(music_files / "song"), str(music_files / "twice"), "warehouse")
    tables = jobs.build_music_star(*args)
    assert tables["songs"].count() == 2 and tables["songplays"].count() == 6


def test_second_batch_goes_on(spark, music_files):
    out = str(music_files / "grown")
    args = (spark, str(music_files / "log/2018/11"), str(music_files / "song"), out, "keyed", "insert_if_absent")
    counts = []
    for _ in range(3):
        tables = jobs.build_music_star(*args)
        counts.append({name: df.count() for name, df in tables.items()})
    assert counts[0] == counts[1] == counts[2]
    write(music_files / "log/2018/11/later.json", play(MS + 86_400_000))
    ids = [r[0] for r in jobs.build_music_star(*args)["songplays"].select("songplay_id").collect()]
    assert sorted(ids) == list(range(1, counts[0]["songplays"] + 2))
    with pytest.raises(ValueError):
        jobs.build_music_star(*args[:4], "lake", "insert_if_absent")


def test_log_staged_by_json_paths(spark, music_files):
    renamed = {"userId": "$.who.id", "page": "$.p"}
    paths = [renamed.get(name, f"$.{name}") for name in ACTIVITY_LOG.names]
    line = json.loads(play(MS))
    line["who"], line["p"] = {"id": line.pop("userId")}, line.pop("page")
    write(music_files / "nested/d.json", json.dumps(line))
    out = str(music_files / "nested-out")
    tables = jobs.build_music_star(
        spark, str(music_files / "nested"), str(music_files / "song"), out, "keyed", log_paths=paths
    )
    assert [r["user_id"] for r in tables["songplays"].collect()] == [7]


def test_unknown_rules(spark, music_files):
    with pytest.raises(ValueError):
        jobs.build_music_star(spark, str(music_files / "log/2018/11"), str(music_files / "song"), str(music_files / "o"), "x")


def test_hourly_run_is_idempotent_and_loads_one_month(spark, music_files):
    template, songs, root = str(music_files / "log/{year}/{month}"), str(music_files / "song"), str(music_files / "wh")
    write(music_files / "log/2018/12/d.json", play(MS + 40 * 86400000, user="9", lastName="Poe"))

    def counts():
        return {t: spark.read.parquet(f"{root}/{t}").count() for t in MUSIC_STAR}

    report = run_hourly(spark, "2018-11-05", template, songs, root)
    assert report.where("NOT passed").count() == 0
    november = counts()
    assert november == {"songplays": 2, "users": 2, "songs": 2, "artists": 2, "time": 2}
    run_hourly(spark, "2018-11-05", template, songs, root)
    assert counts() == november
    # a late line of the same month, then the next month
    with open(music_files / "log/2018/11/late.json", "w") as late:
        late.write(play(MS + 60000))
    run_hourly(spark, "2018-11-30", template, songs, root)
    assert counts()["songplays"] == 3
    run_hourly(spark, "2018-12-31", template, songs, root)
    assert counts() == {"songplays": 4, "users": 3, "songs": 2, "artists": 2, "time": 4}


def test_hourly_modes_and_failing_check(spark, music_files):
    template, songs, root = str(music_files / "log/{year}/{month}"), str(music_files / "song"), str(music_files / "wh2")
    for _ in range(2):
        run_hourly(spark, "2018-11-05", template, songs, root, dim_mode="append")
    assert spark.read.parquet(f"{root}/users").count() == 4
    run_hourly(spark, "2018-11-05", template, songs, root, dim_mode="overwrite")
    assert spark.read.parquet(f"{root}/users").count() == 2
    write(music_files / "log/2019/1/d.json", json.dumps(dict(page="Home", ts=MS, userId="")))
    with pytest.raises(QualityError, match="users has rows"):
        run_hourly(spark, "2019-01-01", template, songs, str(music_files / "wh3"))


def test_lookups(spark, tmp_path):
    write(
        tmp_path / "ev/1.csv",
        EVENT_HEADER
        + event("Faith", 4, 338, "It's music", 50) + event("", 5, 338, "", 50)
        + event("B", 1, 182, "Second", 10, "Sylvie") + event("A", 0, 182, "First", 10, "Sylvie"),
    )
    write(tmp_path / "ev/2.csv", EVENT_HEADER + event("C", 9, 7, "First", 11, "Tom") + event("C", 10, 7, "First", 11, "Tom"))
    out = str(tmp_path / "out")
    jobs.build_lookups(spark, str(tmp_path / "ev"), out)
    assert [tuple(r) for r in lookups.play_in_session(spark, out, 338, 4).collect()] == [("Faith", "It's music", 200.5)]
    session = lookups.plays_of_session(spark, out, 10, 182)
    assert [tuple(r) for r in session.collect()] == [
        ("A", "First", "Sylvie", "Lee"), ("B", "Second", "Sylvie", "Lee"),
    ]
    listeners = lookups.listeners_of_song(spark, out, "First")
    assert sorted(tuple(r) for r in listeners.collect()) == [("First", "Sylvie", "Lee"), ("First", "Tom", "Lee")]
    plan = lookups.play_in_session(spark, out, 338, 4)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(sessionId,338)" in plan and "EqualTo(itemInSession,4)" in plan
    assert spark.read.csv(f"{out}/plays_csv", header=True).count() == 5


def test_lookup_rows_last_write_and_quotes(spark):
    events = spark.createDataFrame(
        [(1, 1, "a'b", "old", 1.0, 1), (1, 1, "c'd", "new", 2.0, 2)],
        "sessionId int, itemInSession int, artist string, song string, length double, n int",
    )
    rows = lookups.lookup_rows(events, "songInfo", ["n"], without_quotes=True)
    assert [tuple(r) for r in rows.collect()] == [(1, 1, "cd", "new", 2.0)]
    assert rows.schema["length"].dataType.simpleString() == "float"


def arrivals_inputs(spark, root):
    spark.createDataFrame([arrival(), arrival(cicid=2.0, gender="null")], ARRIVALS).write.parquet(f"{root}/m1")
    spark.createDataFrame([arrival(cicid=3.0)], ARRIVALS).selectExpr(
        "*", "1 AS insnum"
    ).drop("gender").write.parquet(f"{root}/m2")
    write(root / "temp.csv", "dt,AverageTemperature,AverageTemperatureUncertainty,State,Country\n"
          "2012-01-01,3.5,0.1,Texas,United States\n2012-01-01,,0.1,Ohio,United States\n1999-01-01,1,1,Ohio,United States\n")
    write(root / "cities.csv", "City;State;Median Age;Male Population;Female Population;Total Population;"
          "Number of Veterans;Foreign-born;Average Household Size;State Code;Race;Count\n"
          "Miami;Florida;30;1;2;3;1;1;2.5;FL;White;7\n")
    write(root / "airports.csv", "ident,type,name,iso-country\nA,heliport,Pad,US\n")
    write(root / "labels.sas", LABELS)
    jobs.land_arrivals(
        spark, [f"{root}/m1", f"{root}/m2"], f"{root}/temp.csv", f"{root}/cities.csv", f"{root}/airports.csv", f"{root}/lake"
    )


def test_arrivals_star(spark, tmp_path):
    arrivals_inputs(spark, tmp_path)
    assert spark.read.parquet(f"{tmp_path}/lake/raw/airport_data").columns[-1] == "iso_country"
    report = jobs.build_arrivals_star(spark, f"{tmp_path}/lake", f"{tmp_path}/labels.sas", f"{tmp_path}/out")
    assert report.where("NOT passed").count() == 0
    fact = spark.read.parquet(f"{tmp_path}/out/ops/immigrations_table")
    assert sorted(tuple(r) for r in fact.select("cicid", "i94cit", "i94visa").collect()) == [
        (1, "mexico air sea", "Pleasure"), (2, "mexico air sea", "Pleasure"), (3, "mexico air sea", "Pleasure"),
    ]
    states = spark.read.parquet(f"{tmp_path}/out/ops/us_state_temperatures_table")
    assert states.where("state = 'Texas'").first()["average_temperature"] == 3.5 and states.count() == 2


def test_arrivals_star_without_rows_fails_its_checks(spark, tmp_path):
    arrivals_inputs(spark, tmp_path)
    write(tmp_path / "labels2.sas", LABELS.replace("582", "583"))
    with pytest.raises(QualityError, match="immigrations_table has rows"):
        jobs.build_arrivals_star(spark, f"{tmp_path}/lake", f"{tmp_path}/labels2.sas", f"{tmp_path}/out")
