"""Fact and dimensions of the arrivals (immigration) star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import text
from starloom.functions.timeparts import date_to_sas_day, sas_day_to_date, time_parts
from starloom.operators.clean import cast_columns, not_before
from starloom.operators.frames import literal_table, pivot_sum, sum_numeric
from starloom.operators.joins import label_join, role_join
from starloom.schemas import DEMOGRAPHICS_COUNTS

# Meaning of the mode and visa codes.
MODES = {1: "Air", 2: "Sea", 3: "Land", 9: "Not reported"}
VISAS = {1: "Business", 2: "Pleasure", 3: "Student"}
FIRST_DAY = "2016-01-01"  # fixed value: start of the reporting period
CLIMATE_YEAR = 2012  # fixed value: last complete year of the temperature data


def countries_codes(texts: DataFrame, order: list[str]) -> DataFrame:
    codes = text.extract_codes(texts, "value", text.COUNTRY_CODES, order)
    return codes.select(F.col("id").alias("country_id"), F.lower("label").alias("country"))


def states_codes(texts: DataFrame, order: list[str]) -> DataFrame:
    codes = text.extract_codes(texts, "value", text.STATE_CODES, order, text.PORTS_AMONG_STATES)
    return codes.select(F.col("id").alias("state_id"), F.lower("label").alias("state"))


def cities_table(texts: DataFrame, order: list[str]) -> DataFrame:
    codes = text.extract_codes(texts, "value", text.CITY_CODES, order)
    return codes.select(F.col("id").alias("city_id"), *text.split_city_state(F.col("label")))


def modes_table(spark: SparkSession) -> DataFrame:
    return literal_table(spark, MODES, "mode_id", "mode")


def visas_table(spark: SparkSession) -> DataFrame:
    return literal_table(spark, VISAS, "visa_id", "visa")


def arrivals_stage(raw: DataFrame, countries: DataFrame, first_day: str = FIRST_DAY) -> DataFrame:
    """Cleaned arrivals with real dates and the labels of their codes.

    Rows drop out that lack a departure, lie before ``first_day`` or carry an
    unknown mode, visa or country code. The cheap row filters run before the
    joins, and the joins meet code lists only.
    """
    clean = text.null_words(raw)
    recent = not_before(clean, ["arrdate", "depdate"], date_to_sas_day(F.lit(first_day).cast("date")))
    dated = recent.withColumns(
        {"arrdate_ts": sas_day_to_date(F.col("arrdate")), "depdate_ts": sas_day_to_date(F.col("depdate"))}
    )
    coded = label_join(dated, MODES, "i94mode", "mode")
    coded = label_join(coded, VISAS, "i94visa", "visa")
    roles = {"i94cit": "i94cit_country", "i94res": "i94res_country"}
    return role_join(coded, countries, roles, "country_id", "country")


def arrivals_fact(stage: DataFrame) -> DataFrame:
    """The 16 fact columns, distinct."""
    whole = {c: F.col(c).try_cast("int").alias(c) for c in ("cicid", "i94mode", "i94yr", "i94mon", "i94bir")}
    return stage.select(
        whole["cicid"],
        "arrdate_ts",
        "depdate_ts",
        "i94port",
        whole["i94mode"],
        "airline",
        "fltno",
        whole["i94yr"],
        whole["i94mon"],
        "visatype",
        F.col("visa").alias("i94visa"),
        whole["i94bir"],
        F.col("i94cit_country").alias("i94cit"),
        F.col("i94res_country").alias("i94res"),
        "i94addr",
        "gender",
    ).distinct()


def states_table(demographics: DataFrame, races: list[str] | None = None) -> DataFrame:
    """Population counts per state.

    The source repeats a city once per race. The pivot brings a city back to
    one row, so its population enters the state sum once.
    """
    counts = cast_columns(demographics, {c: "int" for c in [*DEMOGRAPHICS_COUNTS, "Count"]})
    cities = pivot_sum(counts, ["State_Code", "State", *DEMOGRAPHICS_COUNTS], "Race", "Count", races)
    states = text.clean_headers(sum_numeric(cities, ["State_Code", "State"]))
    return states.toDF(*[c.lower() for c in states.columns])


def state_temperatures(temperatures: DataFrame, year: int | None = CLIMATE_YEAR) -> DataFrame:
    """Typed readings of one year, or of all years."""
    day = F.col("dt").try_cast("date")
    readings = temperatures if year is None else temperatures.where(F.col("dt").startswith(str(year)))
    return readings.select(
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.col("AverageTemperature").try_cast("double").alias("average_temperature"),
        F.col("State").alias("state"),
        F.col("Country").alias("country"),
    )


def country_temperatures(states: DataFrame) -> DataFrame:
    """Mean over the states per country and month; missing readings are left out."""
    return (
        states.groupBy("country", "month", "year")
        .agg(F.avg("average_temperature").alias("average_temperature"))
        .withColumn("country", F.lower("country"))
    )


def date_table(fact: DataFrame) -> DataFrame:
    """Every arrival and departure date once, with its parts."""
    dates = (
        fact.select(F.explode(F.array("arrdate_ts", "depdate_ts")).alias("date"))
        .where(F.col("date").isNotNull())
        .distinct()
    )
    return dates.select("date", *time_parts(F.col("date"), hour=False))
