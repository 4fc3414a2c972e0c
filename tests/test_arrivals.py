import datetime as dt

import pytest

from starloom.plans import arrivals, reports
from starloom.schemas import ARRIVALS


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def arrival(**given):
    base = dict(
        cicid=1.0, i94yr=2016.0, i94mon=4.0, i94cit=582.0, i94res=101.0, i94port="MIA", arrdate=20545.0, i94mode=1.0,
        i94addr="FL", depdate=20550.0, i94bir=33.0, i94visa=2.0, airline="AA", fltno="12", visatype="B2", gender="F",
    )
    base.update(given)
    return tuple(base[name] for name in ARRIVALS.names)


@pytest.fixture(scope="module")
def countries(spark):
    return spark.createDataFrame([("582", "mexico"), ("101", "albania")], "country_id string, country string")


@pytest.fixture(scope="module")
def raw(spark):
    data = [
        arrival(),
        arrival(),  # an exact copy
        arrival(cicid=2.0, airline="NaN", gender="None", i94mode=9.0, i94visa=3.0),
        arrival(cicid=3.0, arrdate=20453.0),  # before the period
        arrival(cicid=4.0, depdate=None),
        arrival(cicid=5.0, i94mode=7.0),
        arrival(cicid=6.0, i94mode=None),
        arrival(cicid=7.0, i94cit=999.0),
        arrival(cicid=8.0, i94visa=None),
    ]
    return spark.createDataFrame(data, ARRIVALS)


def test_fact(raw, countries):
    fact = arrivals.arrivals_fact(arrivals.arrivals_stage(raw, countries))
    assert fact.columns == [
        "cicid", "arrdate_ts", "depdate_ts", "i94port", "i94mode", "airline", "fltno", "i94yr", "i94mon", "visatype",
        "i94visa", "i94bir", "i94cit", "i94res", "i94addr", "gender",
    ]
    got = rows(fact.select("cicid", "arrdate_ts", "i94visa", "i94cit", "i94res", "airline", "gender"))
    day = dt.date(2016, 4, 1)
    assert got == [
        (1, day, "Pleasure", "mexico", "albania", "AA", "F"),
        (2, day, "Student", "mexico", "albania", None, None),
    ]


def test_dates_are_the_union_of_both_roles(raw, countries):
    fact = arrivals.arrivals_fact(arrivals.arrivals_stage(raw, countries))
    assert rows(arrivals.date_table(fact)) == [
        (dt.date(2016, 4, 1), 1, 13, 4, 2016, 4),
        (dt.date(2016, 4, 6), 6, 14, 4, 2016, 2),
    ]


def test_states(spark):
    columns = "City string, State string, `Median Age` string, `Male Population` string, `Female Population` string, " \
        "`Total Population` string, `Number of Veterans` string, `Foreign-born` string, `State Code` string, " \
        "Race string, Count string"
    data = [
        ("x", "Calif", "30", "4", "6", "10", "1", "2", "CA", "White", "5"),
        ("x", "Calif", "30", "4", "6", "10", "1", "2", "CA", "Black or African-American", "2"),
        ("y", "Calif", "31", "1", None, "2", "bad", "0", "CA", "White", "1"),
    ]
    from starloom.functions.text import clean_headers

    states = arrivals.states_table(clean_headers(spark.createDataFrame(data, columns)))
    assert states.columns == [
        "state_code", "state", "male_population", "female_population", "total_population", "number_of_veterans",
        "foreign_born", "black_or_african_american", "white",
    ]
    assert rows(states) == [("CA", "Calif", 5, 6, 12, 1, 2, 2, 6)]


def test_temperatures(spark):
    data = [("2012-03-01", "10.5", "NY", "USA"), ("2012-03-01", None, "CA", "USA"), ("2012-03-01", "11.5", "WA", "USA"),
            ("2011-03-01", "99", "NY", "USA")]
    raw = spark.createDataFrame(data, "dt string, AverageTemperature string, State string, Country string")
    states = arrivals.state_temperatures(raw)
    assert rows(states)[0] == (2012, 3, 10.5, "NY", "USA") and states.count() == 3
    assert rows(arrivals.country_temperatures(states)) == [("usa", 3, 2012, 11.0)]


def test_weekday_report(spark, raw, countries):
    fact = arrivals.arrivals_fact(arrivals.arrivals_stage(raw, countries))
    cities = spark.createDataFrame([("MIA", "MIAMI", "FL"), ("NYC", "NEW YORK", "NY")], "city_id string, city string, state_code string")
    assert rows(reports.arrivals_by_weekday(fact, arrivals.date_table(fact), cities, "FL")) == [(4, 2)]
    assert rows(reports.arrivals_by_weekday(fact, arrivals.date_table(fact), cities, "NY")) == []


def test_code_lists_meet_by_broadcast_only(raw, countries):
    plan = arrivals.arrivals_stage(raw, arrivals.modes_table(raw.sparkSession).selectExpr(
        "mode_id AS country_id", "mode AS country"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2
    assert "Exchange hashpartitioning" not in plan and "Python" not in plan
