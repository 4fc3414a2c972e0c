"""The raw inputs of the two stars, derived row by row from the given tables.

``activity_log``    events: one log line per event; the page ``purchase`` is a play of song ``k``
``song_metadata``   part: one song per part, three songs per title, four per artist
``arrivals_raw``    lineitem: one arrival per line
``temperatures``    lineitem: one reading per line
``demographics``    customer: one (city, group) count per customer

The SQL texts state the same derivations for the comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.queries.registry import table

PLAY = "purchase"  # the page of a play in the given tables


def activity_log(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumns(
        {
            "k": F.get_json_object("props", "$.k").cast("bigint"),
            "play": F.col("event_type") == "purchase",
        }
    )
    return events.selectExpr(
        "event_id",
        "unix_millis(cast(ts as timestamp)) AS ts",
        "event_type AS page",
        "if(event_id % 101 = 0, NULL, user_id) AS userId",
        "concat('First ', user_id % 97) AS firstName",
        "concat('Last ', user_id % 1009) AS lastName",
        "if(user_id % 2 = 0, 'F', 'M') AS gender",
        "if(value >= 60, 'paid', 'free') AS level",
        "if(play, concat('Track ', k div 3), NULL) AS song",
        "if(play, concat('Artist ', k div 4), NULL) AS artist",
        "if(play, round(900 + k / 10D, 2) + if(event_id % 7 = 0, 0.75D, 0D), NULL) AS length",
        "user_id * 10 + day(ts) div 10 AS sessionId",
        "concat('City ', user_id % 40, ', S', user_id % 10) AS location",
        "concat('agent ', event_id % 5) AS userAgent",
    )


LOG_SQL = """log AS (
  SELECT event_id, epoch_us(ts) // 1000 AS ts,
         event_type AS page,
         CASE WHEN event_id % 101 = 0 THEN NULL ELSE user_id END AS userId,
         'First ' || (user_id % 97) AS firstName, 'Last ' || (user_id % 1009) AS lastName,
         CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CASE WHEN value >= 60 THEN 'paid' ELSE 'free' END AS level,
         CASE WHEN play THEN 'Track ' || (k // 3) END AS song,
         CASE WHEN play THEN 'Artist ' || (k // 4) END AS artist,
         CASE WHEN play THEN round(900 + k / 10.0::DOUBLE, 2)
              + CASE WHEN event_id % 7 = 0 THEN 0.75::DOUBLE ELSE 0::DOUBLE END END AS length,
         user_id * 10 + day(ts) // 10 AS sessionId,
         'City ' || (user_id % 40) || ', S' || (user_id % 10) AS location,
         'agent ' || (event_id % 5) AS userAgent
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
               event_type = 'purchase' AS play FROM events))"""


def song_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "concat('S', p_partkey) AS song_id",
        "concat('Track ', p_partkey div 3) AS title",
        "p_retailprice AS duration",
        "cast(if(p_size > 40, 0, 1960 + p_size) as int) AS year",
        "concat('A', p_partkey div 4) AS artist_id",
        "concat('Artist ', p_partkey div 4) AS artist_name",
        "if(p_size % 5 = 0, NULL, p_type) AS artist_location",
        "if(p_size % 4 = 0, NULL, p_size * 1.5D) AS artist_latitude",
        "if(p_size % 3 = 0, NULL, p_size * -2D) AS artist_longitude",
    )


META_SQL = """meta AS (
  SELECT 'S' || p_partkey AS song_id, 'Track ' || (p_partkey // 3) AS title,
         p_retailprice AS duration,
         CAST(CASE WHEN p_size > 40 THEN 0 ELSE 1960 + p_size END AS INTEGER) AS year,
         'A' || (p_partkey // 4) AS artist_id, 'Artist ' || (p_partkey // 4) AS artist_name,
         CASE WHEN p_size % 5 <> 0 THEN p_type END AS artist_location,
         CASE WHEN p_size % 4 <> 0 THEN p_size * 1.5::DOUBLE END AS artist_latitude,
         CASE WHEN p_size % 3 <> 0 THEN p_size * -2.0::DOUBLE END AS artist_longitude
  FROM part)"""

DAY_ONE = "1998-01-01"


def arrivals_raw(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").withColumn(
        "arr", F.expr("datediff(l_shipdate, date'1960-01-01')").cast("double")
    )
    return lines.selectExpr(
        "cast(l_orderkey * 10 + l_linenumber as double) AS cicid",
        "cast(year(l_shipdate) as double) AS i94yr",
        "cast(month(l_shipdate) as double) AS i94mon",
        "cast(l_suppkey % 27 as double) AS i94cit",
        "cast(l_partkey % 26 as double) AS i94res",
        "concat('P', lpad(cast(l_partkey % 60 as string), 2, '0')) AS i94port",
        "arr AS arrdate",
        "cast(if(l_linenumber = 7, 9, l_linenumber) as double) AS i94mode",
        "concat('S', l_partkey % 10) AS i94addr",
        "CASE l_quantity WHEN 7 THEN NULL WHEN 8 THEN 0D ELSE arr + l_quantity END AS depdate",
        "l_quantity AS i94bir",
        "CASE WHEN l_returnflag = 'A' THEN 1D WHEN l_returnflag = 'R' THEN 2D "
        "WHEN l_linestatus = 'O' THEN 3D END AS i94visa",
        "CASE WHEN l_tax < 0.005 THEN 'NaN' WHEN l_tax < 0.015 THEN 'None' "
        "ELSE concat('AL', l_partkey % 30) END AS airline",
        "cast(l_partkey as string) AS fltno",
        "concat(l_returnflag, l_linestatus) AS visatype",
        "if(l_discount < 0.005, 'null', if(l_partkey % 2 = 0, 'F', 'M')) AS gender",
    )


ARRIVALS_SQL = """arr0 AS (
  SELECT *, CAST(date_diff('day', DATE '1960-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS arr
  FROM lineitem),
arrivals AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS DOUBLE) AS cicid,
         CAST(year(l_shipdate) AS DOUBLE) AS i94yr, CAST(month(l_shipdate) AS DOUBLE) AS i94mon,
         CAST(l_suppkey % 27 AS DOUBLE) AS i94cit, CAST(l_partkey % 26 AS DOUBLE) AS i94res,
         'P' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') AS i94port,
         arr AS arrdate,
         CAST(CASE WHEN l_linenumber = 7 THEN 9 ELSE l_linenumber END AS DOUBLE) AS i94mode,
         'S' || (l_partkey % 10) AS i94addr,
         CASE l_quantity WHEN 7 THEN NULL WHEN 8 THEN 0 ELSE arr + l_quantity END AS depdate,
         l_quantity AS i94bir,
         CASE WHEN l_returnflag = 'A' THEN 1.0 WHEN l_returnflag = 'R' THEN 2.0
              WHEN l_linestatus = 'O' THEN 3.0 END AS i94visa,
         CASE WHEN l_tax < 0.005 THEN 'NaN' WHEN l_tax < 0.015 THEN 'None'
              ELSE 'AL' || (l_partkey % 30) END AS airline,
         CAST(l_partkey AS VARCHAR) AS fltno,
         l_returnflag || l_linestatus AS visatype,
         CASE WHEN l_discount < 0.005 THEN 'null' WHEN l_partkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender
  FROM arr0)"""


def countries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").selectExpr(
        "lpad(cast(n_nationkey as string), 3, '0') AS country_id", "lower(n_name) AS country"
    )


def label_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Label text in the three code formats, one text of several lines per customer."""
    return table(spark, folder, "customer").selectExpr(
        "c_custkey",
        r"""concat(
          '/*  Codes of customer ', c_custkey, '   in  ', c_mktsegment, ' */\n',
          lpad(cast(c_custkey % 1000 as string), 3, '0'), ' =  \'', c_name, '\'\n',
          '\'', substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', c_nationkey + 1, 1), substr(c_mktsegment, 1, 1),
          '\'=\'', c_mktsegment, '  \'\n',
          '\'', lpad(cast(c_custkey % 500 as string), 3, 'X'), '\'\t=\t\'INT\'\'L ', c_name,
          if(c_custkey % 9 = 0, '', ', '), if(c_custkey % 9 = 0, '', substr(c_mktsegment, 1, 2)),
          '   \'\n') AS value""",
    )


def temperatures(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(
        "date_format(l_shipdate, 'yyyy-MM-dd') AS dt",
        "if(l_linenumber = 7, NULL, cast(l_quantity as string)) AS AverageTemperature",
        "cast(l_tax as string) AS AverageTemperatureUncertainty",
        "concat('State ', l_suppkey % 40) AS State",
        "concat('NATION_', l_suppkey % 25) AS Country",
    )


TEMPERATURES_SQL = """temps AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS dt,
         CASE WHEN l_linenumber <> 7 THEN l_quantity END AS temperature,
         'State ' || (l_suppkey % 40) AS State, 'NATION_' || (l_suppkey % 25) AS Country
  FROM lineitem)"""

# the five market segments of the given tables
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def demographics(spark: SparkSession, folder: str) -> DataFrame:
    """Five rows, one per segment, describe one city and repeat its population."""
    city = "(c_custkey div 5)"
    return table(spark, folder, "customer").selectExpr(
        f"concat('S', {city} % 50) AS State_Code",
        f"concat('State ', {city} % 50) AS State",
        f"concat('City ', {city}) AS City",
        f"cast({city} % 1000 as string) AS Male_Population",
        f"cast({city} % 900 as string) AS Female_Population",
        f"cast({city} % 1000 + {city} % 900 as string) AS Total_Population",
        f"cast({city} % 70 as string) AS Number_of_Veterans",
        f"cast({city} % 80 as string) AS Foreign_born",
        "c_mktsegment AS Race",
        "cast(cast(c_custkey % 4000 as int) as string) AS Count",
    )


DEMOGRAPHICS_SQL = """demo0 AS (SELECT *, c_custkey // 5 AS city FROM customer),
demo AS (
  SELECT 'S' || (city % 50) AS state_code, 'State ' || (city % 50) AS state,
         city % 1000 AS male_population, city % 900 AS female_population,
         city % 1000 + city % 900 AS total_population, city % 70 AS number_of_veterans,
         city % 80 AS foreign_born, c_mktsegment AS race, c_custkey % 4000 AS n
  FROM demo0)"""
