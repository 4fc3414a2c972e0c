"""The keyed music star fed by streams over its source folders: each run reads only the files that are new."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas
from starloom.functions.timeparts import epoch_ms_to_ts
from starloom.operators.keys import dense_ids
from starloom.plans import music, quality
from starloom.session import pin_utc
from starloom.sinks import audit
from starloom.sinks.loads import read_as, rows_to_insert, table_exists
from starloom.sources.staging import marked

MONTHS = ["year", "month"]


def run_intake(
    spark: SparkSession,
    logs: str,
    songs: str,
    root: str,
    most_rejected: float = 1.0,
    files_per_batch: int | None = None,
) -> dict[str, int]:
    """Load the song and log files that no run before has loaded; returns the lines read per source.

    A file stream per source, ended when nothing is left, keeps in its checkpoint below ``root``/intake which
    files it has seen. Every batch is staged, checked on the counts of its own writes, and published
    by inserting absent keys only. A run that is killed, at whatever point, leaves its batch open; the
    next run gets the same files under the same batch number, writes over what was staged and adds
    what is not there yet, so nothing comes twice and nothing is lost. A batch whose checks fail, or that has a
    larger share of unreadable lines than ``most_rejected``, changes no table and stays open.

    Songs come first, so that plays find them; plays loaded before their song's file keep ids of NULL.
    """
    pin_utc(spark)
    read = {"songs": _run(spark, "songs", songs, schemas.SONG_METADATA, _load_songs, root, most_rejected, files_per_batch)}
    read["logs"] = _run(spark, "logs", logs, schemas.ACTIVITY_LOG, _load_logs, root, most_rejected, files_per_batch)
    return read


def _run(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType,
    apply: Callable[[DataFrame, str, str], None],
    root: str,
    most_rejected: float,
    files_per_batch: int | None,
) -> int:
    """Drain one source; lines read in this run. The error of a failed check is raised as it is."""
    failed: list[quality.QualityError] = []

    def batch(lines: DataFrame, number: int) -> None:
        try:
            work = f"{root}/intake/{name}/batch"
            parsed = marked(lines.where("trim(value) <> ''"), "value", schema)
            rejects = f"{root}/rejects/{name}/batch={number}"
            good = audit.stage_lines(parsed, f"{work}/lines", rejects, f"{name}, batch {number}", most_rejected)
            apply(good, work, f"{root}/tables")
        except quality.QualityError as error:
            failed.append(error)
            raise

    reader = spark.readStream.format("text").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = (
        reader.load(path)
        .writeStream.foreachBatch(batch)
        .option("checkpointLocation", f"{root}/intake/{name}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    try:
        stream.awaitTermination()
    except StreamingQueryException:
        if failed:
            raise failed[0] from None
        raise
    return sum(progress.numInputRows for progress in stream.recentProgress)


def _load_songs(songs: DataFrame, work: str, tables: str) -> None:
    dims = {
        "songs": music.songs_dim(songs.where("song_id is not null"), "first"),
        "artists": music.artists_dim(songs, "first"),
    }
    _insert(songs.sparkSession, {n: (rows, schemas.MUSIC_KEYS[n], None) for n, rows in dims.items()}, work, tables)


def _load_logs(lines: DataFrame, work: str, tables: str) -> None:
    log = music.typed_log(lines)
    spark, played = log.sparkSession, music.plays(log)
    month = lambda df: df.withColumns({"year": F.year("start_time"), "month": F.month("start_time")})
    dims = {
        "users": (music.users_dim(played, "first_seen"), ["user_id"], None),
        "time": (music.time_dim(played, epoch_ms_to_ts(F.col("ts")), weekday="name"), ["start_time", *MONTHS], MONTHS),
    }
    found = month(music.songplays_keyed(log, _dim(spark, tables, "songs"), _dim(spark, tables, "artists")))
    path, keys = f"{tables}/songplays", ["start_time", "user_id", *MONTHS]
    if table_exists(spark, path):
        have = spark.read.parquet(path)
        start = (have.agg(F.max("songplay_id")).first()[0] or 0) + 1
        ids = {"songplay_id": F.lit(0).cast("bigint")}
        new = rows_to_insert(found.withColumns(ids), path, keys, [c for c in found.columns if c not in keys], MONTHS)
        new = new.drop("songplay_id")
    else:
        start, new = 1, found
    fact = dense_ids(new, ["start_time", "user_id"], "songplay_id", start)
    _insert(spark, dims, work, tables, {"songplays": (fact, ["songplay_id"], MONTHS)})


def _dim(spark: SparkSession, tables: str, name: str) -> DataFrame:
    empty = spark.createDataFrame([], schemas.MUSIC_STAR[name])
    return read_as(empty, f"{tables}/{name}") if table_exists(spark, f"{tables}/{name}") else empty


def _insert(spark: SparkSession, dims: dict, work: str, tables: str, facts: dict | None = None) -> None:
    """Stage all tables, check their keys by what the writes counted, then publish, facts last.

    The rows of ``dims`` are compared with the visible ones by key; ``facts`` are new already.
    """
    staged, parts = {}, {}
    for name, (rows, keys, partition_by) in {**dims, **(facts or {})}.items():
        if name in dims:
            order = [c for c in rows.columns if c not in keys]
            rows = rows_to_insert(rows, f"{tables}/{name}", keys, order, partition_by)
        checked = [k for k in keys if k not in MONTHS]
        staged[name] = audit.stage(rows, f"{work}/{name}", audit.null_counts(checked), partition_by)
        parts[name] = (checked, partition_by)
    quality.require(quality.stated_checks(spark, audit.key_checks(staged, {n: k for n, (k, _) in parts.items()})))
    for name, (_, partition_by) in parts.items():
        audit.publish(staged[name], f"{tables}/{name}", partition_by)
