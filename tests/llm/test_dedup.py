"""Exact and near duplicates, vectors and components against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from starloom.llm import components, embedding_dedup, exact_dedup, simhash

SCHEMA = "doc_id long, text string, row string, name string, fp string, key string, kept string"


def _texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    base = [" ".join(rng.choices(words, k=n)) for n in (1, 2, 3, 30, 400, 3000)]
    texts = [*base, *base[2:5], base[3].replace(" ", "\n\t "), base[4].upper(), None, "", "", " ", "\x0b\t", "é ß", "é ß"]
    texts += [base[4][:-1] + "x", base[5] + " tail", "a" * 50_000, "a" * 50_001, base[5]]
    return [(None if i == 4 else i, t) for i, t in enumerate(texts)] + [(6, base[2]), (None, base[3])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "r", "n", "f", "k", "z") for i, t in _texts()], SCHEMA)


def _normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(docs, weak):
    hashed = (lambda b: F.length(b).cast("bigint") % 2) if weak else F.xxhash64
    got = exact_dedup.exact_groups(docs, block_bytes=64, hashed=hashed).collect()
    groups = {}
    for i, t in _texts():
        groups.setdefault(_normal(t), []).append(i)
    expected = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        digest = hashlib.sha256(text.encode()).hexdigest()
        expected += [(i, min(known, default=None), len(ids), digest) for i in ids]
    rows = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
    stays = {}
    for r in got:
        stays.setdefault(r.text_sha256, []).append(r.kept)
    assert all(sum(kept) == 1 for kept in stays.values())


def test_stages_keep_one_row_per_group_and_all_columns(docs):
    exact = exact_dedup.drop_exact_duplicates(docs)
    assert exact.columns == docs.columns
    assert exact.count() == len({_normal(t) for _, t in _texts()})
    near = simhash.drop_near_duplicates(docs)
    assert near.columns == docs.columns and near.count() == len(set(_components(_texts()).values()))


def _fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(texts):
    prints = [_fingerprint(t) for _, t in texts]
    labels = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 and labels[i] != labels[j]:
                old, new = max(labels[i], labels[j]), min(labels[i], labels[j])
                labels = [new if x == old else x for x in labels]
    return dict(enumerate(labels))


def test_simhash(docs):
    texts = _texts()
    groups = {}
    for place, label in _components(texts).items():
        groups.setdefault(label, []).append(texts[place])
    expected = []
    for members in groups.values():
        low = min((i for i, _ in members if i is not None), default=None)
        expected += [(i, f"{_fingerprint(t):016x}", low) for i, t in members]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_groups(docs).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("list_rows", [3, 2000])
def test_all_close_fingerprints_are_found(spark, list_rows):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(100)}
    for p in list(prints)[:30]:
        prints |= {p ^ (1 << rng.randrange(64)) ^ (rng.choice([0, 1]) << rng.randrange(64)) for _ in range(6)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.close_fingerprints(spark.createDataFrame([(p,) for p in signed], "fp long"), list_rows=list_rows)
    close = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2
    assert {tuple(r) for r in found.collect()} == {(a, b) for a in signed for b in signed if a < b and close(a, b)}


@pytest.mark.parametrize("max_bits", [1, 2, 3])
def test_families_that_share_bytes(spark, max_bits):
    """Thousands of fingerprints under one key of four bytes, and of six: longer keys hold the lists down."""
    rng = random.Random(6)
    base = 0x8123456789ABCDEF
    prints = {base ^ rng.getrandbits(32) << 32 for _ in range(1500)} | {base ^ rng.getrandbits(16) << 16 for _ in range(700)}
    prints |= {p ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for p in list(prints)[:300]}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = simhash.close_fingerprints(rows, max_bits, list_rows=100).collect()
    values = np.array(sorted(signed))
    bits = np.bitwise_count((values[:, None] ^ values).view(np.uint64))
    i, j = np.nonzero(np.triu(bits <= max_bits, 1))
    assert {tuple(r) for r in found} == set(zip(values[i].tolist(), values[j].tolist())) and len(found) == len(i)
    lists = simhash.posting_lists(rows, max_bits, list_rows=100)
    longest = lists.groupBy(*simhash.LIST).count().agg({"count": "max"}).first()[0]
    assert longest <= max(100, 1 << 4 * max_bits)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(7, 7), (None, 3), (1, 0)]
    got = dict(map(tuple, components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(80)}}


def _vectors():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 16))
    near = [base[i % 5] + rng.normal(size=16) * s for i, s in enumerate(np.linspace(0.01, 0.5, 60))]
    rows = [x.tolist() for x in [*base, *near, base[0], base[0], base[1] * 3, -base[2]]]
    rows += [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] * 16, [None] * 16, base[0][:4].tolist()]
    return [(None if i == 7 else i, v) for i, v in enumerate(rows)] + [(3, rows[3])]


@pytest.mark.parametrize("blocks, rows", [(4, 10), (4, 8192), (1, 50)])
def test_near_vectors(spark, blocks, rows):
    data = _vectors()
    df = spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id long, embedding array<double>, cls int")
    usable = [v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v) for _, v in data]
    unit = np.array([np.array(v) / np.linalg.norm(v) if ok else np.zeros(16) for (_, v), ok in zip(data, usable)])
    link = unit @ unit.T >= 0.95
    np.fill_diagonal(link, False)
    label = np.arange(len(data))
    for _ in data:
        label = np.array([min([label[i], *label[link[i]]]) for i in range(len(data))])
    low = {c: min((data[i][0] for i in range(len(data)) if label[i] == c and data[i][0] is not None), default=None) for c in label}
    expected = [(data[i][0], int(link[i].sum()), low[label[i]], data[i][0] == low[label[i]]) for i in range(len(data))]
    got = embedding_dedup.near_vectors(df, blocks=blocks, rows=rows).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert any(n > 1 for _, n, *_ in expected)


def test_vectors_are_not_shuffled_to_be_compared(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(f"k{i}", x.tolist()) for i, x in enumerate(rng.normal(size=(120, 8)).repeat(2, axis=0))]
    rows += [("z", [0.0, 1.0]), ("y", [-0.0, 1.0])]
    df = spark.createDataFrame(rows, "id string, v array<float>")
    plans, kept = {}, embedding_dedup.materialize

    def recorded(df, name, **options):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return kept(df, name, **options)

    monkeypatch.setattr(embedding_dedup, "materialize", recorded)
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = embedding_dedup.near_vectors(df, "id", "v", least=1 - 1e-9, rows=7)
        last = got._jdf.queryExecution().executedPlan().toString()
        found = {r["id"]: (r["n_links"], r["component_id"]) for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    assert "partitioning" not in plans["links"]
    moved = [line for plan in (*plans.values(), last) for line in plan.splitlines() if "hashpartitioning" in line]
    assert sum("vector" in line for line in moved) == 1
    assert found == {f"k{i}": (1, min(f"k{i}", f"k{i ^ 1}")) for i in range(240)} | {"y": (1, "y"), "z": (1, "y")}


@pytest.mark.parametrize("dims, least", [(64, 0.95), (64, -1.0), (40, 0.8), (3, 0.999), (1, 1.0)])
def test_linked_pairs(dims, least):
    rng = np.random.default_rng(dims)
    base = rng.normal(size=(700, dims))
    units = [base[:620], base[:300] + rng.normal(size=(300, dims)) * 0.1, base[:90] * 2, base[1] + rng.normal(size=(90, dims)) * 0.05]
    units = np.concatenate(units)
    units /= np.sqrt((units * units).sum(axis=1, keepdims=True))
    left, right = units[:563], units[563:]
    for one, two, same in ((left, right, False), (units, units, True)):
        dots = sum(one[:, d, None] * two[:, d] for d in range(dims))
        expected = np.triu(dots >= least, 1) if same else dots >= least
        got = np.zeros_like(dots, int)
        for i, j in embedding_dedup.linked_pairs(one, two, least, embedding_dedup.BLOCKS, same):
            np.add.at(got, (i, j), 1)
        assert (got == expected).all() and expected.any()


def test_empty_tables(spark, docs):
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0
    assert simhash.near_groups(docs.limit(0)).count() == 0
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.near_vectors(none).count() == 0
