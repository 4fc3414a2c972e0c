"""Operators against plain Python on random rows."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starloom.sinks import loads
from starloom.operators import dedup, joins, keys, merge

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
key = st.one_of(st.none(), st.integers(0, 3))
pairs = st.lists(st.tuples(key, st.integers(0, 5)), min_size=1, max_size=40)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@few
@given(left=pairs, right=pairs, how=st.sampled_from(["inner", "left", "left_semi", "left_anti"]))
def test_sliced_join(spark, left, right, how):
    a = spark.createDataFrame(left, "k int, v int")
    b = spark.createDataFrame(right, "k int, w int")
    matches = {k: [w for j, w in right if j == k] for k, _ in left if k is not None}
    expected = Counter()
    for k, v in left:
        found = matches.get(k, [])
        if how == "left_semi":
            expected.update([(k, v)] if found else [])
        elif how == "left_anti":
            expected.update([] if found else [(k, v)])
        else:
            expected.update([(k, v, w) for w in found] or ([(k, v, None)] if how == "left" else []))
    assert bag(joins.sliced_join(a, b, ["k"], how, hot_rows=2)) == expected


@few
@given(rows=pairs)
def test_first_and_last_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int")
    by_key = {}
    for k, v in rows:
        by_key.setdefault(k, []).append(v)
    assert bag(dedup.first_per_key(df, ["k"], ["v"])) == Counter((k, min(v)) for k, v in by_key.items())
    assert bag(dedup.last_per_key(df, ["k"], ["v"])) == Counter((k, max(v)) for k, v in by_key.items())


@few
@given(rows=pairs)
def test_dense_ids(spark, rows):
    df = spark.createDataFrame([(v,) for _, v in rows], "v int")
    numbered = sorted((r["id"], r["v"]) for r in keys.dense_ids(df, ["v"], "id").collect())
    assert numbered == list(enumerate(sorted(v for _, v in rows), 1))


@few
@given(target=st.dictionaries(st.integers(0, 6), st.integers(), max_size=6), batch=st.lists(st.tuples(st.integers(0, 6), st.integers(0, 99)), max_size=20))
def test_merges(spark, target, batch):
    t = spark.createDataFrame([(k, v % 1000) for k, v in target.items()], "k int, v int")
    b = spark.createDataFrame(batch, "k int, v int")
    old = {k: v % 1000 for k, v in target.items()}
    first, last = {}, {}
    for k, v in batch:
        first[k], last[k] = min(v, first.get(k, v)), max(v, last.get(k, v))
    assert dict(t.unionByName(merge.absent_rows(t, b, ["k"], ["v"])).collect()) == {**first, **old}
    assert dict(merge.upserted(t, b, ["k"], ["v"]).collect()) == {**old, **last}


def test_null_and_nan_keys_do_not_depend_on_limits(spark, tmp_path, monkeypatch):
    nan = float("nan")
    left = spark.createDataFrame([(k,) for k in [nan] * 5 + [0.0, -0.0, None, 1.0] * 4], "k double")
    right = spark.createDataFrame([(k,) for k in [nan] * 3 + [0.0, 1.0, None]], "k double")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = left.join(right, "k", how).count()
        for hot in (1, 4, 100):
            assert joins.sliced_join(left, right, ["k"], how, hot_rows=hot).count() == plain, (how, hot)
    old = spark.createDataFrame([(1, None), (2, None), (3, 2018)], "id int, year int")
    new = spark.createDataFrame([(9, None), (3, 2018)], "id int, year int")
    found = []
    for limit in (0, 1, 500):
        monkeypatch.setattr(loads, "LITERAL_PARTITIONS", limit)
        path = str(tmp_path / f"t{limit}")
        loads.load(old, path, partition_by=["year"])
        for _ in range(3):
            loads.upsert(new, path, ["id", "year"], [], ["year"])
        found.append(sorted(map(tuple, spark.read.parquet(path).select("id", "year").collect()), key=repr))
    assert found[0] == found[1] == found[2] and len(found[0]) == 4


def test_nan_days_are_no_dates(spark):
    from starloom.functions.timeparts import sas_day_to_date
    from starloom.operators.clean import not_before

    days = spark.createDataFrame([(float("nan"),), (0.0,), (20454.0,), (None,)], "d double")
    assert [r[0] is None for r in days.select(sas_day_to_date(days.d)).collect()] == [True, True, False, True]
    from pyspark.sql import functions as F

    assert not_before(days, ["d"], F.lit(1)).count() == 1
