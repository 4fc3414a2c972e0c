"""Data-quality checks on the given tables. A failing check is a row, not an error."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.plans import quality
from starloom.queries.inputs import LOG_SQL, activity_log
from starloom.queries.registry import query, table
from starloom.sinks.layout import register_views


def _row(name: str, actual: str, expected: int) -> str:
    return (
        f"SELECT '{name}' AS \"check\", CAST(CAST(({actual}) AS BIGINT) AS VARCHAR) AS actual, '{expected}' AS expected, "
        f"coalesce(({actual}) = {expected}, false) AS passed"
    )


CHECKS = [
    {"check_sql": "SELECT CAST(try_divide(count(*), count(*)) AS INT) FROM checked_users", "expected_result": 1},
    {"check_sql": "SELECT CAST(try_divide(count(*), count(*)) AS INT) FROM checked_users WHERE user_id < 0", "expected_result": 1},
    {"check_sql": "SELECT count(*) FROM checked_users WHERE user_id IS NULL", "expected_result": 0},
    {"check_sql": "SELECT count(*) FROM checked_songs WHERE p_partkey IS NULL", "expected_result": 0},
]


@query(
    f"WITH {LOG_SQL}, u AS (SELECT userId AS user_id FROM log) "
    + " UNION ALL ".join(
        _row(check["check_sql"], actual, check["expected_result"])
        for check, actual in zip(
            CHECKS,
            [
                "SELECT count(*) // nullif(count(*), 0) FROM u",
                "SELECT count(*) // nullif(count(*), 0) FROM u WHERE user_id < 0",
                "SELECT count(*) FROM u WHERE user_id IS NULL",
                "SELECT count(*) FROM part WHERE p_partkey IS NULL",
            ],
        )
    )
)
def dq_expected_results(spark, folder):
    """SQL checks against expected values; one has no rows to divide, one finds NULL ids."""
    users = activity_log(spark, folder).select(F.col("userId").alias("user_id"))
    register_views({"checked_users": users, "checked_songs": table(spark, folder, "part")})
    return quality.sql_checks(spark, CHECKS)


@query(
    f"WITH {LOG_SQL} "
    + " UNION ALL ".join(
        _row(f"log.{c} has no null", f"SELECT count(*) - count({c}) FROM log", 0) for c in ("event_id", "userId", "song")
    )
)
def dq_not_null(spark, folder):
    return quality.not_null(activity_log(spark, folder), "log", ["event_id", "userId", "song"])


@query(
    _row(
        "lineitem key (l_orderkey, l_linenumber) is unique",
        "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)",
        0,
    )
    + " UNION ALL "
    + _row("orders key (o_orderkey) is unique", "SELECT count(*) - count(DISTINCT o_orderkey) FROM orders", 0)
)
def dq_unique_key(spark, folder):
    lines = quality.unique_key(table(spark, folder, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])
    return lines.unionAll(quality.unique_key(table(spark, folder, "orders"), "orders", ["o_orderkey"]))


@query(
    _row("orders.o_custkey refers to c_custkey", "SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)", 0)
    + " UNION ALL "
    + _row(
        "lineitem.l_suppkey refers to s_suppkey",
        "SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey <> 3)",
        0,
    )
)
def dq_referential(spark, folder):
    """The second dimension lacks one nation's suppliers, so its check fails."""
    most = table(spark, folder, "supplier").where("s_nationkey <> 3")
    orders = quality.references(
        table(spark, folder, "orders"), "orders", "o_custkey", table(spark, folder, "customer"), "c_custkey"
    )
    return orders.unionAll(quality.references(table(spark, folder, "lineitem"), "lineitem", "l_suppkey", most, "s_suppkey"))


@query(
    """SELECT l_suppkey, count(*) AS rows FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey <> 3) GROUP BY l_suppkey"""
)
def dq_orphan_rows(spark, folder):
    most = table(spark, folder, "supplier").where("s_nationkey <> 3")
    return quality.orphan_rows(table(spark, folder, "lineitem"), "l_suppkey", most, "s_suppkey")


FOUND, EXPECTED = ["customer", "nation", "orders"], ["customer", "orders", "shipments"]


@query(
    " UNION ALL ".join(
        [_row(f"{t} is expected", f"SELECT {int(t in EXPECTED)}", 1) for t in FOUND]
        + [_row(f"{t} is found", f"SELECT {int(t in FOUND)}", 1) for t in EXPECTED]
        + [_row(f"{t} has two columns", "SELECT 1", 1) for t in FOUND]
        + [_row(f"{t} has rows", f"SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM {t}", 1) for t in FOUND]
    )
)
def dq_table_set(spark, folder):
    """One table is unknown and one is missing."""
    return quality.table_set(spark, {t: table(spark, folder, t) for t in FOUND}, EXPECTED)
