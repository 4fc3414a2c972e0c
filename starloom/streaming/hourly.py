"""The scheduled load of the music star: one run loads the month of its run date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas
from starloom.plans import music, quality
from starloom.session import pin_utc
from starloom.sinks import audit
from starloom.sinks.loads import load, read_as, rows_to_insert, table_exists
from starloom.sources import files
from starloom.sources.staging import marked, month_path, read_lines

MONTHS = ["year", "month"]
# Which columns of the new rows must not be NULL before they become visible, and which tables must have rows.
CHECKED_KEYS = {"users": ["user_id"], "songs": ["song_id"]}
FILLED = ["users", "songs"]


def run_hourly(
    spark: SparkSession,
    run_date: str,
    log_template: str,
    songs: str,
    root: str,
    dim_mode: str = "insert_if_absent",
    most_rejected: float = 1.0,
) -> DataFrame:
    """Stage → fact → dimensions → checks → publish. Rerunning a date adds nothing.

    ``log_template`` holds ``{year}`` and ``{month}``, so only the month of
    ``run_date`` is read. Fact and time rows are compared with that month's
    partitions only. ``dim_mode`` may also be ``append`` (no comparison) or
    ``overwrite`` for the dimensions.

    New rows are staged below ``root``/staging and counted as they are written. The checks look at these
    counts; when one fails, no visible table has changed. Lines that do not fit the log's schema go
    to ``root``/rejects/run_date; a run with a larger share of them than ``most_rejected`` fails.
    """
    pin_utc(spark)
    lines = read_lines(spark, month_path(log_template, run_date)).where("trim(value) <> ''")
    parsed = marked(lines, "value", schemas.ACTIVITY_LOG)
    good = audit.stage_lines(
        parsed, f"{root}/staging/events", f"{root}/rejects/run_date={run_date}", f"log of {run_date}", most_rejected
    )
    log = music.typed_log(good)
    metadata = load(files.read_songs(spark, songs), f"{root}/staging/songs", "overwrite")
    played = music.plays(log)

    # written once: the fact, its partitions and the times all read it
    strict = music.songplays_strict(log, metadata)
    plays = load(
        strict.withColumns({"year": F.year("start_time"), "month": F.month("start_time")}),
        f"{root}/staging/plays",
        "overwrite",
    )
    inserting = dim_mode == "insert_if_absent"
    fact = rows_to_insert(plays, f"{root}/songplays", ["songplay_id", *MONTHS], ["session_id"], MONTHS)
    staged = {"songplays": audit.stage(fact, f"{root}/staging/new/songplays", None, MONTHS)}

    # inserting needs the times of this run's plays only; the other modes rebuild from the whole fact
    timed = plays
    if not inserting and table_exists(spark, f"{root}/songplays"):
        timed = read_as(plays, f"{root}/songplays").unionByName(staged["songplays"].rows)
    dims = {
        "users": (music.users_dim(played, "first_seen"), ["user_id"], None),
        "songs": (music.songs_dim(metadata.where("song_id is not null"), "first"), ["song_id"], None),
        "artists": (music.artists_dim(metadata, "first"), ["artist_id"], None),
        "time": (music.time_dim(timed, F.col("start_time"), weekday="sunday0"), ["start_time", *MONTHS], MONTHS),
    }
    partitions = {"songplays": MONTHS}
    for name, (rows, keys, partition_by) in dims.items():
        audit.recover(spark, f"{root}/{name}")
        if inserting:
            rows = rows_to_insert(rows, f"{root}/{name}", keys, [c for c in rows.columns if c not in keys], partition_by)
        measures = audit.null_counts(CHECKED_KEYS.get(name, []))
        staged[name] = audit.stage(rows, f"{root}/staging/new/{name}", measures, partition_by)
        partitions[name] = partition_by

    report = quality.stated_checks(
        spark,
        audit.row_checks(spark, staged, FILLED, None if dim_mode == "overwrite" else root)
        + audit.key_checks(staged, CHECKED_KEYS),
    )
    quality.require(report)
    for name in [*dims, "songplays"]:  # the fact last: its keys are there before it
        if dim_mode == "overwrite" and name in dims:
            audit.swap(spark, staged[name], f"{root}/{name}")
        else:
            audit.publish(staged[name], f"{root}/{name}", partitions[name])
    return report
