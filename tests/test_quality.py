import pytest
from pyspark.sql import functions as F

from starloom.plans import quality


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "c")], "k int, v string")


def test_not_null_unique_and_references(spark, table):
    assert rows(quality.not_null(table, "t", ["k", "v"])) == [
        ("t.k has no null", "1", "0", False), ("t.v has no null", "1", "0", False),
    ]
    assert rows(quality.unique_key(table, "t", ["k"])) == [("t key (k) is unique", "1", "0", False)]
    assert rows(quality.unique_key(table, "t", ["v"]))[0][3] is True
    dim = spark.createDataFrame([(2,), (2,)], "id int")
    assert rows(quality.references(table, "t", "k", dim, "id")) == [("t.k refers to id", "2", "0", False)]
    assert rows(quality.orphan_rows(table, "k", dim, "id")) == [(1, 2)]
    assert rows(quality.references(table.where("k = 2"), "t", "k", dim, "id"))[0][3] is True


def test_checks_on_one_table_share_a_pass(table):
    checks = quality.not_null(table, "t", ["k", "v"])
    assert checks._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1


def test_sql_checks_report_every_failure(spark, table):
    table.createOrReplaceTempView("checked")
    results = quality.sql_checks(
        spark,
        [
            {"check_sql": "SELECT count(*) FROM checked", "expected_result": 4},
            {"check_sql": "SELECT try_divide(count(*), count(*)) FROM checked WHERE k > 9", "expected_result": 1},
            {"check_sql": "SELECT count(*) FROM checked WHERE k IS NULL", "expected_result": 0},
            {"check_sql": "SELECT max(v) FROM checked", "expected_result": "c"},
        ],
    )
    assert [r[1:] for r in rows(results)] == [("4", "4", True), (None, "1", False), ("1", "0", False), ("c", "c", True)]
    with pytest.raises(quality.QualityError) as error:
        quality.require(results)
    assert "k > 9" in str(error.value) and "k IS NULL" in str(error.value)
    quality.require(results.where("passed"))


def test_ratio_of_an_empty_table_is_null(table):
    checks = {"has rows": (quality.non_empty_ratio(), 1)}
    assert rows(quality.table_checks(table, checks)) == [("has rows", "1", "1", True)]
    assert rows(quality.table_checks(table.limit(0), checks)) == [("has rows", None, "1", False)]


def test_table_set(spark, table):
    found = {"a": table, "odd": table.select("k").where(F.lit(False))}
    failed = {r["check"] for r in quality.table_set(spark, found, ["a", "gone"]).where("NOT passed").collect()}
    assert failed == {"odd is expected", "gone is found", "odd has two columns", "odd has rows"}
    assert quality.table_set(spark, {"a": table}, ["a"]).where("NOT passed").count() == 0
