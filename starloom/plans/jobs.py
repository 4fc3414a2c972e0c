"""End-to-end jobs: files in, star schema out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions.text import clean_headers
from starloom.functions.timeparts import epoch_ms_to_text, epoch_ms_to_ts
from starloom.operators.keys import dense_ids, gap_ids
from starloom.operators.merge import absent_rows
from starloom.plans import arrivals, lookups, music, quality
from starloom.session import materialize, pin_utc
from starloom.sinks.audit import stage_lines
from starloom.sinks.loads import export_csv, insert_if_absent, land_raw, load, read_as, table_exists
from starloom.sources import files
from starloom.sources.staging import marked, read_lines, stage_by_path

MONTHS = ["year", "month"]


def _with_month(df: DataFrame) -> DataFrame:
    """Partition columns of a table that has a start time."""
    return df.withColumns({"year": F.year("start_time"), "month": F.month("start_time")})


def stage_music(
    spark: SparkSession,
    logs: str,
    songs: str,
    out: str,
    log_paths: list[str] | None = None,
    most_rejected: float = 1.0,
) -> tuple[DataFrame, DataFrame]:
    """Parse the JSON sources once into staging tables; every later step reads those.

    ``log_paths`` lists one JSON path per log column, for logs whose keys do
    not carry the column names. Without it, lines that do not fit the log's schema go to ``out``/rejects,
    and a larger share of them than ``most_rejected`` ends the job.
    """
    lines = read_lines(spark, logs)
    if log_paths:
        by_path = stage_by_path(lines, "value", log_paths, schemas.ACTIVITY_LOG)
        log = load(music.typed_log(by_path), f"{out}/staging/events", "overwrite")
    else:
        parsed = marked(lines.where("trim(value) <> ''"), "value", schemas.ACTIVITY_LOG)
        good = stage_lines(parsed, f"{out}/staging/events", f"{out}/rejects", "log", most_rejected)
        log = music.typed_log(good)
    return log, load(files.read_songs(spark, songs), f"{out}/staging/songs", "overwrite")


def build_music_star(
    spark: SparkSession,
    logs: str,
    songs: str,
    out: str,
    rules: str = "keyed",
    mode: str = "errorifexists",
    log_paths: list[str] | None = None,
    most_rejected: float = 1.0,
) -> dict[str, DataFrame]:
    """Build the five tables below ``out``/tables under one of the rule sets of ``plans.music``.

    Dimensions are written before the fact, and the fact is matched against
    the written songs and artists (``warehouse``: against the staged songs). ``mode="insert_if_absent"`` (``keyed`` rules only)
    adds what the tables do not hold yet; song-play ids go on from the largest.
    """
    pin_utc(spark)
    if mode == "insert_if_absent" and rules != "keyed":
        raise ValueError("only the keyed rules name a key to compare by")
    log, metadata = stage_music(spark, logs, songs, out, log_paths, most_rejected)
    played = music.plays(log)
    tables: dict[str, DataFrame] = {}

    def save(name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        path = f"{out}/tables/{name}"
        if mode != "insert_if_absent":
            tables[name] = load(df, path, mode, partition_by)
        else:
            keys = schemas.MUSIC_KEYS[name] + (partition_by or [])
            insert_if_absent(df, path, keys, [c for c in df.columns if c not in keys], partition_by)
            tables[name] = read_as(df, path)
        return tables[name]

    if rules == "keyed":
        song_dim = save("songs", music.songs_dim(metadata, "first"))
        artist_dim = save("artists", music.artists_dim(metadata, "first"))
        save("users", music.users_dim(played, "first_seen"))
        stamps = epoch_ms_to_ts(F.col("ts"))
        save("time", music.time_dim(played, stamps, weekday="name"), MONTHS)
        found, start = music.songplays_keyed(log, song_dim, artist_dim), 1
        path = f"{out}/tables/songplays"
        if mode == "insert_if_absent" and table_exists(spark, path):
            have = spark.read.parquet(path)
            keys = ["start_time", "user_id"]
            found = absent_rows(have, found, keys, [c for c in found.columns if c not in keys])
            start = (have.agg(F.max("songplay_id")).first()[0] or 0) + 1
        fact = dense_ids(found, ["start_time", "user_id"], "songplay_id", start)
    elif rules == "warehouse":
        save("songs", music.songs_dim(metadata))
        save("artists", music.artists_dim(metadata, defaults=True))
        save("users", music.users_dim(log))
        hours = F.date_trunc("hour", epoch_ms_to_ts(F.col("ts")))
        save("time", music.time_dim(log, hours, weekday="sunday0"), MONTHS)
        fact = dense_ids(
            music.songplays_warehouse(log, metadata),  # the staged songs: one staged twice repeats its plays
            ["start_time", "user_id", "session_id", "song_id", "user_agent", "location", "level", "artist_id"],
            "songplay_id",
            start=0,
        )
    elif rules == "lake":
        song_dim = save("songs", music.songs_dim(metadata, "all"), ["year"])
        artist_dim = save("artists", music.artists_dim(metadata, "all"))
        save("users", music.users_dim(played))
        seconds = epoch_ms_to_text(F.col("ts"))
        save("time", music.time_dim(played, seconds), MONTHS)
        fact = gap_ids(music.songplays_lake(log, song_dim, artist_dim), "songplay_id")
    elif rules == "strict":
        save("songs", music.songs_dim(metadata.where("song_id is not null")))
        save("artists", music.artists_dim(metadata))
        save("users", music.users_dim(played))
        fact_dim = save("songplays", _with_month(music.songplays_strict(log, metadata)), MONTHS)
        times = music.time_dim(fact_dim, F.col("start_time"), weekday="sunday0", distinct=False)
        save("time", times, MONTHS)
        return tables
    else:
        raise ValueError(f"rule set <{rules}> is not known")
    save("songplays", _with_month(fact), MONTHS)
    return tables


def music_quality(tables: dict[str, DataFrame]) -> DataFrame:
    """Key, reference and NULL checks the schema declares, as one report."""
    results = [quality.unique_key(tables[name], name, key) for name, key in schemas.MUSIC_KEYS.items()]
    results += [
        quality.references(tables[fact], fact, column, tables[dim], schemas.MUSIC_KEYS[dim][0])
        for fact, column, dim in schemas.MUSIC_REFERENCES
    ]
    results += [quality.not_null(tables[name], name, key) for name, key in schemas.MUSIC_KEYS.items()]
    report = results[0]
    for result in results[1:]:
        report = report.unionAll(result)
    return report


def build_lookups(spark: SparkSession, events: str, out: str) -> None:
    """Event files → one quoted CSV copy of the plays → the three lookup tables."""
    plays = materialize(files.read_event_csvs(spark, events), "event-plays")  # four writes read it
    export_csv(plays, f"{out}/plays_csv", "overwrite")
    lookups.build_lookup_tables(plays, out)


def land_arrivals(spark: SparkSession, monthly: list[str], temperatures: str, demographics: str, airports: str, out: str) -> None:
    """Copy the four sources to ``out``/raw."""
    land_raw(
        {
            "immigration_data": files.read_monthly(spark, monthly, schemas.ARRIVALS),
            "temp_data": files.read_csv(spark, temperatures, schema=schemas.TEMPERATURES),
            "cities_data": clean_headers(files.read_csv(spark, demographics, sep=";")),
            "airport_data": files.read_csv(spark, airports),
        },
        out,
    )


def build_arrivals_star(
    spark: SparkSession,
    raw_root: str,
    labels: str,
    out: str,
    first_day: str = arrivals.FIRST_DAY,
    climate_year: int = arrivals.CLIMATE_YEAR,
) -> DataFrame:
    """Raw tables and label file → staging → fact → dimensions; returns the quality report.

    Arrivals before ``first_day`` and readings outside ``climate_year`` are left out. Raises when a table is missing, unknown, empty or too narrow.
    """
    pin_utc(spark)
    raw = files.restore_tables(spark, f"{raw_root}/raw")
    texts = files.read_texts(spark, labels)

    tables: dict[str, DataFrame] = {}

    def save(folder: str, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        tables[name] = load(df, f"{out}/{folder}/{name}", partition_by=partition_by)
        return tables[name]

    countries = save("staging", "countries_table", arrivals.countries_codes(texts, ["file"]))
    save("staging", "states_table", arrivals.states_codes(texts, ["file"]))
    save("staging", "modes_table", arrivals.modes_table(spark))
    save("staging", "visas_table", arrivals.visas_table(spark))
    stage = save("staging", "immigrations_stage", arrivals.arrivals_stage(raw["immigration_data"], countries, first_day))

    fact = save("ops", "immigrations_table", arrivals.arrivals_fact(stage), ["i94yr", "i94mon"])
    save("ops", "cities_table", arrivals.cities_table(texts, ["file"]))
    save("ops", "states_table", arrivals.states_table(raw["cities_data"]))
    readings = arrivals.state_temperatures(raw["temp_data"], climate_year)
    climate = save("ops", "us_state_temperatures_table", readings, ["year", "month"])
    save("ops", "country_temperatures_table", arrivals.country_temperatures(climate))
    save("ops", "date_table", arrivals.date_table(fact))

    found = {
        name: tables[name] if name in tables else spark.read.parquet(path)
        for name, path in files.subfolders(spark, f"{out}/ops").items()
    }
    report = quality.table_set(spark, found, schemas.ARRIVALS_STAR)
    quality.require(report)
    return report


