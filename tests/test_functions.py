import datetime as dt

from pyspark.sql import functions as F

from starloom.functions import text, timeparts


def one(df):
    return tuple(df.collect()[0])


def test_epoch_conversions(spark):
    df = spark.createDataFrame([(1541121934796,)], "ts bigint")
    ms, txt, sec = one(
        df.select(
            timeparts.epoch_ms_to_ts(F.col("ts")).cast("string"),
            timeparts.epoch_ms_to_text(F.col("ts")),
            timeparts.epoch_ms_to_second(F.col("ts")).cast("string"),
        )
    )
    assert (ms, txt, sec) == ("2018-11-02 01:25:34.796", "2018-11-02 01:25:34", "2018-11-02 01:25:34")


def test_sas_days(spark):
    df = spark.createDataFrame([(20454.0,), (0.0,), (None,)], "d double")
    got = [r[0] for r in df.select(timeparts.sas_day_to_date(F.col("d"))).collect()]
    assert got == [dt.date(2016, 1, 1), None, None]
    assert one(df.limit(1).select(timeparts.date_to_sas_day(F.lit("2016-01-01").cast("date")))) == (20454,)


def test_time_parts_and_the_three_weekdays(spark):
    # a Sunday that belongs to the last ISO week of the year before
    df = spark.sql("SELECT timestamp'2016-01-03 23:10:00' AS t")
    assert one(df.select(*timeparts.time_parts(F.col("t")))) == (23, 3, 53, 1, 2016, 6)
    assert one(df.select(*timeparts.time_parts(F.col("t"), "sunday0", hour=False))) == (3, 53, 1, 2016, 0)
    assert one(df.select(timeparts.weekday_name(F.col("t")))) == ("Sunday",)


def test_headers_null_words_quotes(spark):
    df = spark.createDataFrame([("NaN", float("nan")), ("x", 1.0), (None, None)], "`a b-c` string, d double")
    clean = text.null_words(text.clean_headers(df))
    assert clean.columns == ["a_b_c", "d"]
    values = [r["a_b_c"] for r in clean.collect()]
    assert values == [None, "x", None]
    assert clean.where("isnan(d)").count() == 1
    assert one(spark.sql("SELECT \"I'm\" AS s").select(text.strip_quotes(F.col("s")))) == ("Im",)


def test_non_empty(spark):
    df = spark.createDataFrame([("",), (None,), ("a",)], "s string")
    assert [r[0] for r in df.where(text.non_empty(F.col("s"))).collect()] == ["a"]


def test_split_city_state(spark):
    df = spark.createDataFrame([("MIAMI, FL",), ("NOWHERE",), ("A, B, C",), (None,)], "s string")
    got = [tuple(r) for r in df.select(*text.split_city_state(F.col("s"))).collect()]
    assert got == [("MIAMI", "FL"), ("NOWHERE", None), ("A", "B"), (None, None)]


LABELS = (
    "/* Country   of\r\n origin */\r\n"
    "   582 =  'MEXICO'\r\n   101 =  'ALBANIA'\r\n   582 =  'MEXICO Air Sea'\r\n"
    "   'AL'='ALABAMA'\r\n   'AG' = 'A PORT'\r\n"
    "   'INL'\t=\t'INT''L FALLS, MN     '\r\n'CP '\t=\t'PADDED'\r\n   'XXX' = 'NOWHERE'\r\n"
    "/* second */"
)


def test_code_lists(spark):
    texts = spark.createDataFrame([("f", LABELS)], "file string, value string")

    def codes(pattern, exclude=None):
        return {r["id"]: r["label"] for r in text.extract_codes(texts, "value", pattern, ["file"], exclude).collect()}

    assert codes(text.COUNTRY_CODES) == {"582": "MEXICO Air Sea", "101": "ALBANIA"}
    assert codes(text.STATE_CODES, text.PORTS_AMONG_STATES) == {"AL": "ALABAMA"}
    assert codes(text.CITY_CODES) == {"INL": "INT'L FALLS, MN", "XXX": "NOWHERE"}


def test_the_later_text_wins(spark):
    texts = spark.createDataFrame([("b", "1 '100' x 100 = 'new'"), ("a", "100 = 'old'")], "file string, value string")
    assert [tuple(r) for r in text.extract_codes(texts, "value", text.COUNTRY_CODES, ["file"]).collect()] == [
        ("100", "new")
    ]


def test_a_long_label_is_read_whole(spark):
    label = "long ''quoted'' text " * 20_000
    texts = spark.createDataFrame([("f", f"'ABC' = '{label}' 'DEF' = 'open")], "file string, value string")
    found = text.extract_codes(texts, "value", text.CITY_CODES, ["file"]).collect()
    assert [(r["id"], r["label"]) for r in found] == [("ABC", label.rstrip().replace("''", "'"))]


def test_comments(spark):
    texts = spark.createDataFrame([("f", LABELS)], "file string, value string")
    got = [r[0] for r in text.extract_comments(texts, "value").collect()]
    assert got == ["Country of origin ", "second "]


def test_no_python_workers_in_the_functions(spark):
    df = spark.range(1).select(
        *timeparts.time_parts(timeparts.epoch_ms_to_ts(F.col("id"))), timeparts.sas_day_to_date(F.col("id")).alias("x")
    )
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
