"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from starloom.llm import lexical_search as search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(ASCII))


def brute(docs, queries, best=10):
    """Every (item, rank, doc, score); documents without an id come last among equals."""
    counts = [(doc, Counter(words(text))) for doc, text in docs if words(text)]
    holding = Counter(t for _, c in counts for t in c)
    total, number = sum(sum(c.values()) for _, c in counts), len(counts)
    rows = []
    for item, text in queries:
        scores = []
        for doc, c in counts:
            m = 100 - 75 + (75 * sum(c.values()) * number) // total
            score = sum(
                math.floor(1000 * math.log((2 * number + 2) / (2 * holding[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in words(text)
                if t in c
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        rows += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:best], 1)]
    return sorted(rows, key=repr)


def ranked(spark, docs, queries, **settings):
    d = spark.createDataFrame([(*row, "x", 1) for row in docs], "id bigint, body string, query string, score int")
    q = spark.createDataFrame([(*row, "y") for row in queries], "id bigint, body string, doc string")
    found = search.ranked(d.repartition(3), q, "id", "body", "id", "body", **settings)
    return sorted(map(tuple, found.select("item", "rank", "doc", "score").collect()), key=repr)


def corpus(seed, documents, vocabulary=300):
    rng = random.Random(seed)
    names = ["".join(rng.choices("abcdeé", k=rng.randint(1, 4))) for _ in range(vocabulary)]
    weights = [1 / (k + 1) for k in range(vocabulary)]
    text = lambda n: " ".join(rng.choices(names, weights, k=n))
    docs = [(i, text(rng.randint(0, 40))) for i in range(documents)]
    return docs, [(i, text(8)) for i in range(12)]


def test_equals_scoring_every_document(spark):
    docs, queries = corpus(1, 900)
    assert ranked(spark, docs, queries) == brute(docs, queries)
    assert ranked(spark, docs, queries, best=3) == brute(docs, queries, 3)


def test_ties_copies_and_missing_ids(spark):
    docs, queries = corpus(2, 60)
    docs += [(i, docs[5][1]) for i in range(1000, 1400)] + [(None, docs[5][1])] * 30 + [(7, docs[7][1])] * 4
    queries += [(100, docs[5][1]), (None, docs[7][1]), (100, docs[5][1])]
    assert ranked(spark, docs, queries) == brute(docs, queries)
    assert ranked(spark, [(None, "one two"), (3, "one two"), (2, "zzz")], [(1, "two")]) == [
        (1, 1, 3, brute([(None, "one two"), (3, "one two"), (2, "zzz")], [(1, "two")])[0][3]),
        (1, 2, None, brute([(None, "one two"), (3, "one two"), (2, "zzz")], [(1, "two")])[1][3]),
    ]


def test_texts_without_terms_and_empty_tables(spark):
    docs = [(1, None), (2, ""), (3, " .,;\x00\x7f"), (4, "Straße ÉTÉ été A1"), (5, "x y z")]
    queries = [(1, None), (2, "..."), (3, "ÉTÉ a1"), (4, "none of these")]
    assert ranked(spark, docs, queries) == brute(docs, queries)
    assert {r[2] for r in ranked(spark, docs, queries)} == {4}
    assert ranked(spark, [], queries) == [] == ranked(spark, docs, []) == ranked(spark, docs[:3], queries)


def test_very_long_text(spark):
    docs = [(1, "alpha beta " * 200_000), (2, "alpha gamma"), (3, "w" * 1_000_000)]
    queries = [(1, "beta alpha"), (2, "w" * 1_000_000 + " gamma")]
    assert ranked(spark, docs, queries) == brute(docs, queries)


def test_queries_in_blocks(spark, monkeypatch):
    docs, queries = corpus(3, 200)
    monkeypatch.setattr(search, "QUERY_BYTES", 300)
    assert ranked(spark, docs, queries) == brute(docs, queries)


def test_bounds_hold_and_prune():
    """Whatever lies below a node scores at most its bound, and far subtrees stay closed."""
    rng = np.random.default_rng(5)
    weights = rng.integers(1, 9000, 400)
    rows = []
    for i in range(1500):
        group = (i % 10) * 40
        terms = np.sort(rng.choice(40, 12, replace=False) + group).astype(np.int32)
        rows.append((i, terms, rng.integers(1, 900_000, 12)))
    tree = search.BallTree(rows, weights, 10)
    asked, counts = np.arange(40, 52, dtype=np.int32), np.ones(12, dtype=np.int64)
    exact = {d: int(sum(weights[t] * v for t, v in zip(terms, values) if 40 <= t < 52)) for d, terms, values in rows}
    scaled = np.sqrt(weights[asked])
    for node, (left, right, below) in enumerate(tree.nodes):
        if below is not None:
            at, center = tree.centers[node]
            dense = np.zeros(400)
            dense[at] = center
            shared = scaled * (dense[asked] > 0)
            bound = dense[asked] @ scaled + np.sqrt(shared @ shared) * tree.radii[node]
            assert max(exact[tree.docs[row][0]] for row in below[0]) <= bound * (1 + 1e-12) + 1
    heap = []
    scored = tree.search(asked, counts, weights, heap, 10)
    best = sorted(exact.items(), key=lambda e: (-e[1], e[0]))[:10]
    assert sorted((-score, -number) for score, _, number in heap) == sorted((-s, d) for d, s in best)
    assert scored < len(rows) / 2


@pytest.mark.parametrize("seed", [5, 6, 8])
def test_rows_far_from_both_ends_stay_with_their_like(seed):
    """Rows that share no term with the two far rows are halved by their terms, not by rounding."""
    rng = np.random.default_rng(seed)
    weights = rng.integers(1, 9000, 400)
    rows = [
        (i, np.sort(rng.choice(40, 12, replace=False) + i % 10 * 40).astype(np.int32), rng.integers(1, 900_000, 12))
        for i in range(1500)
    ]
    asked, counts = np.arange(40, 52, dtype=np.int32), np.ones(12, dtype=np.int64)
    assert search.BallTree(rows, weights, 10).search(asked, counts, weights, [], 10) < 300


@pytest.mark.parametrize("text, expected", [(None, []), ("A_b-C9é", [b"a", b"b", "c9é".encode()]), ("İ x", ["İ x".encode()])])
def test_terms(text, expected):
    assert search.terms_of(text) == expected and [w.encode() for w in words(text)] == expected
