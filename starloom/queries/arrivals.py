"""Arrivals star on lineitem (arrivals, readings), nation (countries) and customer (labels, cities)."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import text
from starloom.functions.timeparts import date_to_sas_day, sas_day_to_date
from starloom.operators.clean import not_before
from starloom.operators.frames import distinct_union, pivot_map, pivot_sum
from starloom.operators.joins import code_join, name_join, role_join
from starloom.plans import arrivals, reports, rollups
from starloom.queries.inputs import (
    ARRIVALS_SQL,
    DAY_ONE,
    DEMOGRAPHICS_SQL,
    SEGMENTS,
    TEMPERATURES_SQL,
    arrivals_raw,
    countries,
    demographics,
    label_lines,
    temperatures,
)
from starloom.queries.registry import query, table
from starloom.session import scratch_path
from starloom.sinks.loads import load

FIRST = f"date_diff('day', DATE '1960-01-01', DATE '{DAY_ONE}')"
TO_DATE = "strftime(DATE '1960-01-01' + CAST({} AS INTEGER), '%Y-%m-%d')"


def _date_text(column: str):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


# -- rows and dates --------------------------------------------------------------


@query(f"WITH {ARRIVALS_SQL} SELECT cicid, arrdate, depdate FROM arrivals WHERE arrdate >= {FIRST} AND depdate >= {FIRST}")
def min_date_filter(spark, folder):
    bound = date_to_sas_day(F.lit(DAY_ONE).cast("date"))
    return not_before(arrivals_raw(spark, folder), ["arrdate", "depdate"], bound).select("cicid", "arrdate", "depdate")


@query(
    f"""WITH {ARRIVALS_SQL} SELECT cicid, {TO_DATE.format('arrdate')} AS arrdate_ts,
CASE WHEN depdate <> 0 THEN {TO_DATE.format('depdate')} END AS depdate_ts FROM arrivals"""
)
def run_sas_day_to_date(spark, folder):
    raw = arrivals_raw(spark, folder).select(
        "cicid",
        sas_day_to_date(F.col("arrdate")).alias("arrdate_ts"),
        sas_day_to_date(F.col("depdate")).alias("depdate_ts"),
    )
    return raw.select("cicid", _date_text("arrdate_ts"), _date_text("depdate_ts"))


@query(
    f"""WITH {ARRIVALS_SQL} SELECT cicid, nullif(nullif(airline, 'NaN'), 'None') AS airline,
nullif(gender, 'null') AS gender, depdate FROM arrivals"""
)
def null_sentinel_clean(spark, folder):
    return text.null_words(arrivals_raw(spark, folder).select("cicid", "airline", "gender", "depdate"))


# -- code lists ------------------------------------------------------------------


@query(
    """SELECT lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS id, arg_max(c_name, c_custkey) AS label
FROM customer GROUP BY c_custkey % 1000"""
)
def code_list_extract(spark, folder):
    """Codes repeat once there are over 1000 customers; the last one counts."""
    return text.extract_codes(label_lines(spark, folder), "value", text.COUNTRY_CODES, ["c_custkey"])


CODE = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', c_nationkey + 1, 1) || substr(c_mktsegment, 1, 1)"


@query(
    f"""SELECT {CODE} AS id, arg_max(c_mktsegment, c_custkey) AS label FROM customer
WHERE {CODE} NOT IN ('AF', 'NH') GROUP BY {CODE}"""
)
def code_list_exclude(spark, folder):
    return text.extract_codes(label_lines(spark, folder), "value", text.STATE_CODES, ["c_custkey"], ["AF", "NH"])


CITIES = """cities AS (
  SELECT lpad(CAST(c_custkey % 500 AS VARCHAR), 3, 'X') AS city_id,
         'INT''L ' || arg_max(c_name, c_custkey) AS city,
         arg_max(CASE WHEN c_custkey % 9 = 0 THEN '-' ELSE substr(c_mktsegment, 1, 2) END, c_custkey) AS st
  FROM customer GROUP BY c_custkey % 500)"""


@query(f"WITH {CITIES} SELECT city_id, city, nullif(st, '-') AS state_code FROM cities")
def split_city_state(spark, folder):
    """Ports from label text: quotes unescaped, blanks trimmed, the state NULL where there is no comma."""
    return arrivals.cities_table(label_lines(spark, folder), ["c_custkey"])


@query(
    """SELECT 'Codes of customer ' || c_custkey || ' in ' || c_mktsegment || ' ' AS comment FROM customer"""
)
def comment_extract(spark, folder):
    return text.extract_comments(label_lines(spark, folder), "value")


# -- joins to code lists -----------------------------------------------------------


@query(
    f"""WITH {ARRIVALS_SQL}, modes(id, mode) AS (VALUES (1, 'Air'), (2, 'Sea'), (3, 'Land'), (9, 'Not reported'))
SELECT a.cicid, a.i94mode, m.mode FROM arrivals a JOIN modes m ON m.id = a.i94mode"""
)
def run_code_join(spark, folder):
    raw = arrivals_raw(spark, folder).select("cicid", "i94mode")
    return code_join(raw, arrivals.modes_table(spark), "i94mode", "mode_id")


@query(
    f"""WITH {ARRIVALS_SQL} SELECT a.cicid, a.i94cit, a.i94res, lower(c.n_name) AS i94cit_country,
lower(r.n_name) AS i94res_country
FROM arrivals a JOIN nation c ON c.n_nationkey = a.i94cit JOIN nation r ON r.n_nationkey = a.i94res"""
)
def role_playing_join(spark, folder):
    raw = arrivals_raw(spark, folder).select("cicid", "i94cit", "i94res")
    roles = {"i94cit": "i94cit_country", "i94res": "i94res_country"}
    return role_join(raw, countries(spark, folder), roles, "country_id", "country")


@query(
    """SELECT c.c_custkey, c.c_nationkey + 0.0::DOUBLE AS nation_number, lower(n.n_name) AS country
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey"""
)
def mixed_type_join(spark, folder):
    """A fact key stored as a number against codes stored as text with leading zeros."""
    numbered = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("double").alias("nation_number")
    )
    return code_join(numbered, countries(spark, folder), "nation_number", "country_id")


def _climate_columns():
    parts = [F.col(c).cast("bigint").alias(c) for c in ("year", "month")]
    return [*parts, F.round("average_temperature", 6).alias("average_temperature")]


CLIMATE = """climate AS (
  SELECT year(CAST(dt AS DATE)) AS year, month(CAST(dt AS DATE)) AS month,
         temperature AS average_temperature, State AS state, Country AS country
  FROM temps WHERE dt LIKE '1998%')"""
COUNTRY_CLIMATE = """by_country AS (
  SELECT lower(country) AS country, month, year, avg(average_temperature) AS average_temperature
  FROM climate GROUP BY country, month, year)"""


@query(
    f"""WITH {TEMPERATURES_SQL}, {CLIMATE}, {COUNTRY_CLIMATE}
SELECT n.n_nationkey, c.month, round(c.average_temperature, 6) AS average_temperature
FROM by_country c JOIN nation n ON lower(n.n_name) = c.country"""
)
def ci_name_join(spark, folder):
    climate = arrivals.country_temperatures(arrivals.state_temperatures(temperatures(spark, folder), 1998))
    return name_join(climate, table(spark, folder, "nation"), "country", "n_name").select(
        "n_nationkey", F.col("month").cast("bigint").alias("month"), F.round("average_temperature", 6).alias("average_temperature")
    )


EVERY_YEAR = CLIMATE.replace(" WHERE dt LIKE '1998%'", "")


@query(
    f"""WITH {TEMPERATURES_SQL}, {EVERY_YEAR}, {COUNTRY_CLIMATE}
SELECT n.n_nationkey, c.year, c.month, round(c.average_temperature, 6) AS average_temperature
FROM by_country c JOIN nation n ON lower(n.n_name) = c.country"""
)
def ci_name_join_all_years(spark, folder):
    climate = arrivals.country_temperatures(arrivals.state_temperatures(temperatures(spark, folder), None))
    return name_join(climate, table(spark, folder, "nation"), "country", "n_name").select(
        "n_nationkey", *_climate_columns()
    )


# -- builds ------------------------------------------------------------------------

FACT = f"""fact AS (
  SELECT DISTINCT CAST(a.cicid AS INTEGER) AS cicid, {TO_DATE.format('a.arrdate')} AS arrdate_ts,
         {TO_DATE.format('a.depdate')} AS depdate_ts, a.i94port, CAST(a.i94mode AS INTEGER) AS i94mode,
         nullif(nullif(a.airline, 'NaN'), 'None') AS airline, a.fltno, CAST(a.i94yr AS INTEGER) AS i94yr,
         CAST(a.i94mon AS INTEGER) AS i94mon, a.visatype, v.visa AS i94visa,
         CAST(a.i94bir AS INTEGER) AS i94bir, lower(c.n_name) AS i94cit, lower(r.n_name) AS i94res,
         a.i94addr, nullif(a.gender, 'null') AS gender
  FROM arrivals a
  JOIN (VALUES (1), (2), (3), (9)) AS m(mode) ON m.mode = a.i94mode
  JOIN (VALUES (1, 'Business'), (2, 'Pleasure'), (3, 'Student')) AS v(id, visa) ON v.id = a.i94visa
  JOIN nation c ON c.n_nationkey = a.i94cit JOIN nation r ON r.n_nationkey = a.i94res
  WHERE a.arrdate >= {FIRST} AND a.depdate >= {FIRST})"""


def _stage(spark, folder):
    return arrivals.arrivals_stage(arrivals_raw(spark, folder), countries(spark, folder), DAY_ONE)


def _fact(spark, folder):
    return arrivals.arrivals_fact(_stage(spark, folder))


@query(f"WITH {ARRIVALS_SQL}, {FACT} SELECT * FROM fact")
def arrivals_fact(spark, folder):
    fact = _fact(spark, folder)
    return fact.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("arrdate_ts", "depdate_ts")})


@query(
    f"""WITH {ARRIVALS_SQL}, {FACT},
days AS (SELECT arrdate_ts AS date FROM fact UNION SELECT depdate_ts FROM fact),
typed AS (SELECT date, CAST(date AS DATE) AS d FROM days)
SELECT date, CAST(day(d) AS INTEGER) AS day, CAST(week(d) AS INTEGER) AS week, CAST(month(d) AS INTEGER) AS month,
CAST(year(d) AS INTEGER) AS year, CAST(isodow(d) - 1 AS INTEGER) AS weekday FROM typed"""
)
def date_dim_union(spark, folder):
    # the stage holds the same dates as the distinct fact
    dates = arrivals.date_table(_stage(spark, folder))
    return dates.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query(
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
UNION SELECT strftime(l_shipdate, '%Y-%m-%d') FROM lineitem"""
)
def union_distinct(spark, folder):
    ordered = table(spark, folder, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    shipped = table(spark, folder, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"))
    return distinct_union(ordered, shipped)


@query(f"WITH {TEMPERATURES_SQL}, {CLIMATE} SELECT * FROM climate")
def state_temperatures(spark, folder):
    climate = arrivals.state_temperatures(temperatures(spark, folder), 1998)
    return climate.withColumns({"year": F.col("year").cast("bigint"), "month": F.col("month").cast("bigint")})


@query(
    f"""WITH {TEMPERATURES_SQL}, {CLIMATE}, {COUNTRY_CLIMATE}
SELECT country, month, year, round(average_temperature, 6) AS average_temperature FROM by_country"""
)
def avg_by_group(spark, folder):
    climate = arrivals.country_temperatures(arrivals.state_temperatures(temperatures(spark, folder), 1998))
    return climate.select(
        "country",
        F.col("month").cast("bigint").alias("month"),
        F.col("year").cast("bigint").alias("year"),
        F.round("average_temperature", 6).alias("average_temperature"),
    )


@query(
    f"""WITH {TEMPERATURES_SQL}, {EVERY_YEAR}, {COUNTRY_CLIMATE}
SELECT country, month, year, round(average_temperature, 6) AS average_temperature FROM by_country"""
)
def avg_by_group_all_years(spark, folder):
    climate = arrivals.country_temperatures(arrivals.state_temperatures(temperatures(spark, folder), None))
    return climate.select("country", *_climate_columns())


SPREAD = ", ".join(f"CAST(sum(CASE WHEN race = '{s}' THEN n END) AS BIGINT) AS {s}" for s in SEGMENTS)
TUPLE = "state_code, state, male_population, female_population, total_population, number_of_veterans, foreign_born"


@query(f"WITH {DEMOGRAPHICS_SQL} SELECT state_code AS State_Code, {SPREAD} FROM demo GROUP BY state_code")
def run_pivot_sum(spark, folder):
    counts = demographics(spark, folder).withColumn("Count", F.col("Count").try_cast("int"))
    return pivot_sum(counts, ["State_Code"], "Race", "Count", SEGMENTS)


@query(
    """SELECT l_returnflag, coalesce(CAST(nullif(l_partkey % 20000, 7) AS VARCHAR), 'null') AS part,
CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem GROUP BY 1, 2"""
)
def pivot_many_values(spark, folder):
    """As many pivot values as there are parts, one map per row, shown entry by entry."""
    lines = table(spark, folder, "lineitem").selectExpr("l_returnflag", "nullif(l_partkey % 20000, 7) AS part", "l_linenumber")
    wide = pivot_map(lines, ["l_returnflag"], "part", "l_linenumber")
    return wide.select("l_returnflag", F.explode("sums").alias("part", "lines"))


@query(
    f"""WITH {DEMOGRAPHICS_SQL}, cities AS (SELECT {TUPLE}, {SPREAD} FROM demo GROUP BY {TUPLE})
SELECT state_code, state, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in TUPLE.split(', ')[2:])},
{', '.join(f'CAST(sum({s}) AS BIGINT) AS {s.lower()}' for s in SEGMENTS)} FROM cities GROUP BY state_code, state"""
)
def pivot_then_rollup(spark, folder):
    return arrivals.states_table(demographics(spark, folder), SEGMENTS)


WEEKDAYS = f"""WITH {ARRIVALS_SQL}, {FACT}, {CITIES}
SELECT CAST(isodow(CAST(f.arrdate_ts AS DATE)) - 1 AS INTEGER) AS weekday, count(*) AS arrivals
FROM fact f JOIN cities c ON c.city_id = 'X' || substr(f.i94port, 2) WHERE c.st = 'MA' GROUP BY 1"""


@query(WEEKDAYS)
def star_weekday_by_state(spark, folder):
    """Arrivals per weekday at the ports of one state."""
    ports = F.concat(F.lit("X"), F.substring("i94port", 2, 2))
    stage = _stage(spark, folder).withColumn("i94port", ports)
    cities = arrivals.cities_table(label_lines(spark, folder), ["c_custkey"])
    # the state's rows are found before the distinct over 16 columns; they hold all dates that the report can meet
    local = reports.arrivals_in_state(stage, cities, "MA")
    return reports.arrivals_by_weekday(arrivals.arrivals_fact(local), arrivals.date_table(local), cities, "MA")


@query(WEEKDAYS)
def weekday_from_daily_counts(spark, folder):
    """The same report from counts that the load keeps; the first half of the year is loaded again."""
    ports = F.concat(F.lit("X"), F.substring("i94port", 2, 2))
    fact = load(_fact(spark, folder).withColumn("i94port", ports).distinct(), scratch_path(spark, "arrivals-fact"))
    path = scratch_path(spark, "daily-arrivals")
    for months in ("true", "i94mon <= 6"):
        daily = rollups.keep_daily_arrivals(fact.where(months), path)
    cities = arrivals.cities_table(label_lines(spark, folder), ["c_custkey"])
    return rollups.weekdays_of_daily(daily, arrivals.date_table(fact), cities, "MA")
