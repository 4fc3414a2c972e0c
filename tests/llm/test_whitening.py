"""Whitening against plain numpy on exact whole numbers."""

import math

import numpy as np
import pytest

from starloom.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, x string, id string"


def brute(vectors):
    """(n, deviation per vector, whitened per vector and component, explained) of equally long vectors."""
    grid = [tuple(math.floor(64 * float(np.float32(c))) + 1000000 for c in v) for v in vectors]
    fit = sorted(set(grid))
    n, sums = len(fit), [sum(col) for col in zip(*fit)]
    away = [[n * x - s for x, s in zip(row, sums)] for row in grid]
    deviation = [sum(a * a for a in row) for row in away]
    centred = np.array([[n * x - s for x, s in zip(row, sums)] for row in fit]) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1], directions[:, ::-1]
    return n, deviation, (np.array(away) / n) @ directions / np.sqrt(np.abs(values)), values / values.sum()


def frame(spark, vectors):
    rows = [(i, v, "clash", "clash") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def found(spark, vectors, components=16):
    rows = frame(spark, vectors)
    return whitening.whitened(rows, whitening.fit(rows, "embedding", components), "vec_id", "embedding").collect()


@pytest.mark.parametrize("rows, dims, components", [(60, 5, 16), (300, 24, 16), (40, 3, 2)])
def test_equals_numpy(spark, rows, dims, components):
    rng = np.random.default_rng(rows)
    vectors = (rng.normal(size=(rows, dims)) * np.linspace(3, 1, dims)).astype(np.float32).tolist()
    vectors += vectors[:7]  # repeated rows count once in the fit
    n, deviation, expected, explained = brute(vectors)
    got = found(spark, vectors, components)
    kept = min(dims, components)
    assert len(got) == len(vectors) * kept and {r.n for r in got} == {n} == {rows}
    signs = {}
    for r in got:
        assert r.deviation == deviation[r.id]
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        value = expected[r.id][r.component - 1]
        if abs(value) > 1e-6:
            sign = signs.setdefault(r.component, math.copysign(1, value * r.whitened))
            assert r.whitened * sign == pytest.approx(value, rel=1e-6, abs=1e-8)
    assert all(r.identity_error < 1e-8 for r in got)


def test_rows_that_take_no_part(spark):
    good = [[1.0, 2.0, 0.5], [0.0, -1.0, 4.0], [2.0, 2.0, 2.0], [3.0, 0.1, -7.0], [9.0, 1.0, 1.0]]
    bad = [None, [], [1.0, None, 2.0], [float("nan"), 1.0, 1.0], [float("inf"), 0.0, 0.0], [1e30, 0.0, 0.0]]
    got = found(spark, good + bad)
    assert {r.id for r in got} == set(range(5)) and {r.n for r in got} == {5}
    assert found(spark, bad) == [] and found(spark, []) == []


def test_without_spread(spark):
    assert found(spark, [[1.0, 2.0]] * 3) == []  # one distinct vector
    got = found(spark, [[1.0, 5.0, 2.0], [2.0, 5.0, 4.0], [3.0, 5.0, 6.0]])  # a line
    assert {r.component for r in got} == {1} and all(r.explained == pytest.approx(1) for r in got)


def test_lengths_and_missing_keys(spark):
    rows = [(None, [1.0, 2.0]), (7, [3.0, -1.0]), (7, [0.0, 0.0]), (1, [5.0]), (2, [6.0]), (3, [6.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = whitening.whitened(df, whitening.fit(df, "embedding"), "vec_id", "embedding").collect()
    assert sorted((r.id is None, r.id or 0, r.n) for r in got) == sorted(
        [(True, 0, 3)] * 2 + [(False, 7, 3)] * 4 + [(False, 1, 2), (False, 2, 2), (False, 3, 2)]
    )


def test_large_entries_stay_exact(spark):
    vectors = [[2.0**44, 1.0], [-(2.0**44), 2.0], [3.0, 2.0**43]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>")
    models = whitening.fit(df, "embedding")
    grid = [[math.floor(64 * c) + 1000000 for c in v] for v in vectors]
    assert models[2].sums == [sum(c) for c in zip(*grid)]
    # the exact deviation exceeds a bigint
    assert {r.deviation for r in whitening.whitened(df, models, "vec_id", "embedding").collect()} == {None}


@pytest.mark.parametrize(
    "values",
    [
        [5.0] * 10 + [3.0] * 4 + [1.0] * 10,  # equal
        list(np.linspace(1, 2, 14)) + [1.3 + k * 1e-9 for k in range(6)] + [1.7 + k * 1e-13 for k in range(4)],
        [10.0**-k for k in range(12)] + [0.0] * 12,
    ],
)
def test_clustered_eigenvalues(values):
    turn = np.linalg.qr(np.random.default_rng(1).normal(size=(24, 24)))[0]
    matrix = turn @ np.diag(values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found_values, vectors = whitening.eigenvectors(matrix)
    assert np.all(np.diff(found_values) <= 1e-15 * found_values[0])
    assert np.abs(vectors.T @ vectors - np.eye(24)).max() < 2e-15
    residual = matrix.astype(np.longdouble) @ vectors - vectors * found_values
    assert np.abs(residual).max() < 2e-15 * np.abs(matrix).max()


def test_single_precision_alone_would_not_do():
    matrix = np.random.default_rng(2).normal(size=(200, 40))
    matrix = matrix.T @ matrix
    rough = np.linalg.eigh(matrix.astype(np.float32))[1].astype(np.float64)
    exact = whitening.eigenvectors(matrix)[1]
    defect = lambda x: np.abs(np.triu(x.T @ matrix @ x, 1)).max() / np.abs(matrix).max()
    assert defect(rough) > 1e-9 > 1e-14 > defect(exact)
