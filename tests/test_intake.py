"""Incremental intake, quarantine of lines, and checks that gate what becomes visible."""

import json

import pytest

from starloom.plans import jobs
from starloom.plans.quality import QualityError
from starloom.sinks import audit
from starloom.streaming import hourly, intake
from starloom.streaming.hourly import run_hourly
from starloom.streaming.intake import run_intake
from tests.test_jobs import MS, play, song
from tests.test_sources import write

DAY = 86_400_000


@pytest.fixture()
def sources(tmp_path):
    write(tmp_path / "log/1.json", "\n".join([play(MS), play(MS + 5000, song="Miss"), json.dumps(dict(page="Home", ts=MS))]))
    write(tmp_path / "song/A/1.json", song("S1", "A1", "One", "Band", 200.4, 2000))
    return tmp_path


def args(spark, root):
    return spark, str(root / "log"), str(root / "song"), str(root / "star")


def table(spark, root, name):
    return sorted((tuple(r) for r in spark.read.parquet(f"{root}/star/tables/{name}").collect()), key=repr)


def plays(spark, root):
    df = spark.read.parquet(f"{root}/star/tables/songplays")
    return sorted(tuple(r) for r in df.select("songplay_id", "user_id", "song_id").collect())


def test_second_run_reads_only_new_files(spark, sources):
    assert run_intake(*args(spark, sources)) == {"songs": 1, "logs": 3}
    assert plays(spark, sources) == [(1, 7, "S1"), (2, 7, None)]
    assert run_intake(*args(spark, sources)) == {"songs": 0, "logs": 0}
    write(sources / "log/deep/2.json", "\n".join([play(MS + 9000, user="8"), play(MS)]))
    write(sources / "song/B/2.json", song("S2", "A2", "Miss", "Band", 200.4))
    assert run_intake(*args(spark, sources)) == {"songs": 1, "logs": 2}
    # the repeated play stays one, ids go on, a play loaded before its song keeps no id
    assert plays(spark, sources) == [(1, 7, "S1"), (2, 7, None), (3, 8, "S1")]
    assert [r[0] for r in table(spark, sources, "users")] == [7, 8]
    assert len(table(spark, sources, "songs")) == 2 and len(table(spark, sources, "time")) == 3


def test_no_files_at_all(spark, tmp_path):
    for folder in ("log", "song"):
        (tmp_path / folder).mkdir()
    assert run_intake(*args(spark, tmp_path)) == {"songs": 0, "logs": 0}


@pytest.mark.parametrize("after", ["users", "time", "songplays"])
def test_killed_run_repeats_and_loses_nothing(spark, sources, monkeypatch, after):
    """The run dies right after one of its tables has been published."""
    real = audit.publish

    def dying(staged, path, partition_by=None):
        real(staged, path, partition_by)
        if path.endswith(after):
            raise RuntimeError("killed")

    monkeypatch.setattr(intake.audit, "publish", dying)
    with pytest.raises(Exception, match="killed"):
        run_intake(*args(spark, sources))
    monkeypatch.setattr(intake.audit, "publish", real)
    write(sources / "log/2.json", play(MS + 9000, user="8"))
    read = run_intake(*args(spark, sources))
    assert read == {"songs": 0, "logs": 4}  # the open batch again, then the new file
    assert plays(spark, sources) == [(1, 7, "S1"), (2, 7, None), (3, 8, "S1")]
    assert len(table(spark, sources, "users")) == 2 and len(table(spark, sources, "time")) == 3


def test_batches_of_files(spark, sources):
    for i in range(3):
        write(sources / f"log/more{i}.json", play(MS + DAY * (i + 1), user=str(20 + i)))
    assert run_intake(*args(spark, sources), files_per_batch=1)["logs"] == 6
    assert sorted(r[0] for r in plays(spark, sources)) == [1, 2, 3, 4, 5]


def test_bad_lines_are_kept_apart_and_too_many_stop_the_batch(spark, sources):
    run_intake(*args(spark, sources))
    before = plays(spark, sources)
    write(sources / "log/bad.json", "\n".join(["{broken", '{"ts": "late"}', play(MS + 9000, user="8"), "", "  "]))
    with pytest.raises(QualityError, match="2 of 3 lines rejected"):
        run_intake(*args(spark, sources), most_rejected=0.5)
    assert plays(spark, sources) == before
    # the same batch, under a milder rule
    assert run_intake(*args(spark, sources), most_rejected=0.7)["logs"] == 5
    assert [r[1] for r in plays(spark, sources)] == [7, 7, 8]
    rejects = spark.read.parquet(f"{sources}/star/rejects/logs")
    assert sorted(r.text for r in rejects.collect()) == ['{"ts": "late"}', "{broken"]


def test_null_keys_stop_the_batch(spark, sources):
    write(sources / "song/C/3.json", song(None, "A3", "Two", "Duo", 1.0))  # no song: only its artist counts
    assert run_intake(*args(spark, sources))["songs"] == 2
    assert len(table(spark, sources, "songs")) == 1 and len(table(spark, sources, "artists")) == 2


# -- the hourly load -------------------------------------------------------------


def hourly_args(root):
    return str(root / "log/{year}/{month}"), str(root / "song"), str(root / "wh")


def state(spark, root):
    return {
        t: sorted((tuple(r) for r in spark.read.parquet(f"{root}/wh/{t}").collect()), key=repr)
        for t in ("songplays", "users", "songs", "artists", "time")
    }


@pytest.fixture()
def months(tmp_path):
    write(tmp_path / "log/2018/11/d.json", play(MS))
    write(tmp_path / "song/A/1.json", song("S1", "A1", "One", "Band", 200.4, 2000))
    return tmp_path


@pytest.mark.parametrize("mode", ["insert_if_absent", "append", "overwrite"])
def test_failed_check_changes_no_table(spark, months, monkeypatch, mode):
    run_hourly(spark, "2018-11-05", *hourly_args(months))
    before = state(spark, months)
    write(months / "log/2018/11/e.json", play(MS + 7000, user="9"))
    monkeypatch.setitem(hourly.CHECKED_KEYS, "users", ["user_id", "last_name"])
    write(months / "log/2018/11/f.json", play(MS + 8000, user="10", lastName=None))
    with pytest.raises(QualityError, match="users.last_name has no null: 1 instead of 0"):
        run_hourly(spark, "2018-11-05", *hourly_args(months), dim_mode=mode)
    assert state(spark, months) == before
    monkeypatch.undo()
    run_hourly(spark, "2018-11-05", *hourly_args(months), dim_mode=mode)
    after = state(spark, months)
    assert len(after["songplays"]) == 3
    assert len(after["users"]) == {"insert_if_absent": 3, "append": 4, "overwrite": 3}[mode]


def test_checks_scan_no_table(spark, months, monkeypatch):
    """Counts come from the writes; the visible table is looked at only when nothing was staged."""
    looked = []
    real = audit.read_as
    monkeypatch.setattr(audit, "read_as", lambda df, path: looked.append(path) or real(df, path))
    run_hourly(spark, "2018-11-05", *hourly_args(months))
    assert not [p for p in looked if "/staging/" not in p]
    looked.clear()
    run_hourly(spark, "2018-11-05", *hourly_args(months))
    assert [p for p in looked if "/staging/" not in p] == [f"{months}/wh/users", f"{months}/wh/songs"]


def test_killed_between_tables(spark, months, monkeypatch):
    real = audit.publish

    def dying(staged, path, partition_by=None):
        if path.endswith("/artists"):
            raise RuntimeError("killed")
        real(staged, path, partition_by)

    monkeypatch.setattr(hourly.audit, "publish", dying)
    with pytest.raises(RuntimeError):
        run_hourly(spark, "2018-11-05", *hourly_args(months))
    monkeypatch.setattr(hourly.audit, "publish", real)
    run_hourly(spark, "2018-11-05", *hourly_args(months))
    assert {t: len(rows) for t, rows in state(spark, months).items()} == dict.fromkeys(
        ("songplays", "users", "songs", "artists", "time"), 1
    )


def test_swap_and_recovery(spark, tmp_path):
    path = str(tmp_path / "t")
    first = audit.stage(spark.range(3), str(tmp_path / "s1"))
    assert first.counted == {"rows": 3}
    audit.swap(spark, first, path)
    assert spark.read.parquet(path).count() == 3
    (tmp_path / "t").rename(tmp_path / "t__old")  # killed after the first rename
    audit.recover(spark, path)
    assert spark.read.parquet(path).count() == 3
    audit.swap(spark, audit.stage(spark.range(5), str(tmp_path / "s2")), path)
    assert spark.read.parquet(path).count() == 5 and not (tmp_path / "t__old").exists()


def test_batch_jobs_keep_rejects(spark, months):
    write(months / "log/2018/11/bad.json", "{broken\n\n" + play(MS + 3000))
    run = (spark, str(months / "log/2018/11"), str(months / "song"))
    tables = jobs.build_music_star(*run, str(months / "out"), "keyed")
    assert tables["songplays"].count() == 2
    assert [r.text for r in spark.read.parquet(f"{months}/out/rejects").collect()] == ["{broken"]
    with pytest.raises(QualityError, match="1 of 3 lines rejected"):
        jobs.build_music_star(*run, str(months / "out2"), "keyed", most_rejected=0.1)
    assert not (months / "out2/tables").exists()


def test_strict_songs_have_ids(spark, months):
    write(months / "song/B/2.json", song(None, "A2", "Two", "Duo", 9.0))
    tables = jobs.build_music_star(
        spark, str(months / "log/2018/11"), str(months / "song"), str(months / "out"), "strict"
    )
    assert [r.song_id for r in tables["songs"].collect()] == ["S1"] and tables["artists"].count() == 2
