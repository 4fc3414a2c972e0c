"""Every registered query against its SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from starloom.queries import ORACLE, QUERIES
from tests.compare import connect, duck_rows, plain_row, spark_rows

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).columns == ["user_id", "last_name", "songs_played", "artists_played"]


# What each sorted result promises; the columns leave no ties.
ORDERED = {
    "star_plays_by_user": "songs_played DESC, artists_played DESC, user_id, last_name",
    "star_weekday_by_state": "weekday",
    "top_n": "o_totalprice DESC, o_orderkey",
    "duplicate_report": "count DESC, l_orderkey, l_linenumber",
    "lookup_sorted_session": "itemInSession",
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_order_of_rows_equals_sql(spark, con, name):
    order = ORDERED[name]
    keys = [part.split()[0] for part in order.split(", ")]
    found = [tuple(r[k] for k in keys) for r in QUERIES[name](spark, FOLDER).collect()]
    directed = ", ".join(part + (" NULLS LAST" if "DESC" in part else " NULLS FIRST") for part in order.split(", "))
    quoted = ", ".join(f'"{k}"' for k in keys)
    expected = con.execute(f"SELECT {quoted} FROM ({ORACLE[name]}) ORDER BY {directed}").fetchall()
    assert [repr(plain_row(r)) for r in found] == [repr(plain_row(r)) for r in expected]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    names, rows = spark_rows(QUERIES[name](spark, FOLDER))
    expected_names, expected = duck_rows(con, ORACLE[name])
    assert names == expected_names
    assert len(rows) == len(expected)
    assert rows == expected
