"""Whitening of embeddings along the eigenvectors of their covariance.

Counts, sums and the covariance are distributed. The eigenproblem itself, whose size is the dimension of the
vectors and not their number, is solved in single precision and corrected by matrix products in extended
precision (Ogita and Aishima, 2018; clusters as in their second part, 2019).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.support import bounded_batches
from starloom.session import materialize

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
# floor() of larger values is no exact long.
_LARGEST = 2.0**52
_WHOLE = 2.0**62  # below it, sums of whole numbers are taken in 64 bits, beyond in Python's integers
_STEPS = 40

WHITENED = (
    "id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def _tight(matrix: np.ndarray) -> float:
    return float(np.sqrt((matrix.astype(np.float64) ** 2).sum()))


def clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Positions of the values, sorted and cut wherever neighbours differ by more than ``gap``."""
    order = np.argsort(-values, kind="stable")
    cuts = [i for i, (a, b) in enumerate(pairwise(values[order]), 1) if a - b > gap]
    return np.split(order, cuts)


def _corrected(matrix: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One step: better vectors, their values, the width within which values count as one cluster, and the error.

    The products r = I - x'x and s = x'Ax show how far ``x`` is from orthogonal and from diagonalising
    ``matrix``. Between vectors of well separated values the correction follows from both; within a cluster
    only orthogonality is mended.
    """
    r = np.eye(len(matrix), dtype=x.dtype) - x.T @ x
    s = x.T @ (matrix @ x)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    width = 2 * (_tight(off) + _tight(matrix) * _tight(r))
    gaps = values[None, :] - values[:, None]
    apart = np.abs(gaps) > width
    change = np.where(apart, (s + values[None, :] * r) / np.where(apart, gaps, 1), r / 2)
    np.fill_diagonal(change, np.diag(r) / 2)
    return x + x @ change, values, width, _tight(off) / (_tight(matrix) or 1) + _tight(r)


def _split_clusters(matrix: np.ndarray, x: np.ndarray, values: np.ndarray, width: float) -> np.ndarray:
    """Each cluster's vectors turned to the eigenvectors of the shifted matrix within the cluster's own span."""
    x = x.copy()
    for group in clusters(values, width):
        if len(group) > 1:
            basis = np.linalg.qr(x[:, group].astype(np.float64))[0].astype(x.dtype)
            # a second pass brings the basis to the higher precision
            basis = basis + (x[:, group] - basis @ (basis.T @ x[:, group])) @ np.linalg.inv(
                (basis.T @ x[:, group]).astype(np.float64)
            ).astype(x.dtype)
            center = values[group].mean()
            inner = basis.T @ (matrix @ basis - center * basis)
            inner = (inner + inner.T) / 2
            size = float(np.abs(inner).max()) or 1.0
            turn = np.linalg.eigh((inner / size).astype(np.float64))[1]
            x[:, group] = basis @ turn.astype(x.dtype)
    return x


def eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, largest first, and unit eigenvectors (columns) of a symmetric matrix, to double precision.

    Starts from single precision vectors and repeats the correction in extended precision until it gains
    nothing. Whenever values lie closer than the step can tell apart, the cluster is solved by itself; the
    width shrinks with the error, so close but different values part sooner or later. Equal values keep
    any basis of their space. A zero matrix gives unit vectors.
    """
    wide = np.asarray(matrix, dtype=np.longdouble)
    size = np.abs(wide).max() if wide.size else 0
    if not size:
        return np.zeros(len(wide)), np.eye(len(wide))
    wide = (wide + wide.T) / (2 * size)
    x = np.linalg.eigh(wide.astype(np.float32))[1].astype(np.longdouble)
    best, error = x, np.inf
    stalled = 0
    for _ in range(_STEPS):
        better, values, width, now = _corrected(wide, x)
        if now < error:
            stalled = stalled if now > error / 2 else 0
            best, error = x, now
        stalled += 1
        if now < 1e-18 or stalled > 4:
            break
        x = _split_clusters(wide, better, values, width)
    for _ in range(2):  # what noise between almost equal values has bent, without turning anything
        best = best + best @ (np.eye(len(best), dtype=best.dtype) - best.T @ best) / 2
    best = best / np.sqrt((best * best).sum(axis=0))
    values = np.einsum("ij,ij->j", best, wide @ best)
    order = np.argsort(-values, kind="stable")
    return (values[order] * size).astype(np.float64), best[:, order].astype(np.float64)


@dataclass(frozen=True)
class Whitening:
    """What whitens the vectors of one length: at most ``components`` directions, whatever the number of rows."""

    n: int
    sums: list[int]
    vectors: np.ndarray  # one column per component
    values: np.ndarray
    explained: np.ndarray
    identity_error: float


def on_grid(vector: Column) -> Column:
    """floor(64 c) + 1000000 of each entry, as bigint."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + OFFSET)


def whole_vectors(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and holds numbers only.

    Entries of 2^46 or more in size, which the grid cannot hold exactly, count as not finite.
    """
    finite = F.forall(F.col(vector), lambda c: c.isNotNull() & (F.abs(c.cast("double")) * SCALE < _LARGEST))
    return rows.where(F.coalesce(finite, F.lit(False)))


def _grouped(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, matrix) of the vectors of a batch; those without entries are left out."""
    array = batch.column(column)
    sizes = np.asarray(array.value_lengths())
    values, starts = np.asarray(array.flatten()), np.concatenate([[0], np.cumsum(sizes)])
    for length in np.unique(sizes[sizes > 0]):
        places = np.flatnonzero(sizes == length)
        yield int(length), places, values[starts[places][:, None] + np.arange(length)]


def _totals(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length: number and sums of a task's vectors, as decimal text."""
    found: dict[int, list] = {}
    for batch in parts:
        for length, places, x in _grouped(batch, "x"):
            entry = found.setdefault(length, [0, np.zeros(length, dtype=object)])
            exact = np.abs(x).max() * float(len(x)) < _WHOLE
            entry[0] += len(places)
            entry[1] = entry[1] + (x if exact else x.astype(object)).sum(axis=0).astype(object)
    rows = [{"length": k, "n": n, "sums": [str(v) for v in sums]} for k, (n, sums) in found.items()]
    yield pa.RecordBatch.from_pylist(rows, _TOTALS)


_TOTALS = pa.schema([("length", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.string()))])
_PRODUCTS = pa.schema([("length", pa.int32()), ("products", pa.list_(pa.float64()))])


def from_mean(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact; as 64-bit numbers where these can hold it."""
    if float(np.abs(x).max(initial=0)) * n < _WHOLE and max(map(abs, sums), default=0) < _WHOLE:
        return x * np.int64(n) - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def _products(parts: Iterator[pa.RecordBatch], means: dict, vectors: dict) -> Iterator[pa.RecordBatch]:
    """Per length: the sum of outer products of a task's centred (and, where given, projected) vectors."""
    found: dict[int, np.ndarray] = {}
    for batch in parts:
        for length, _, x in _grouped(batch, "x"):
            n, sums = means[length]
            centred = (from_mean(x, n, sums) / n).astype(np.float64)
            if length in vectors:
                centred = centred @ vectors[length]
            found[length] = found.get(length, 0) + centred.T @ centred
    yield pa.RecordBatch.from_pylist([{"length": k, "products": m.ravel()} for k, m in found.items()], _PRODUCTS)


def _summed(rows: DataFrame, values: str, kind: str) -> dict[int, list]:
    """Per length: the tasks' arrays added up entry by entry."""
    entries = rows.select("length", F.posexplode(values).alias("at", "value"))
    added = entries.groupBy("length", "at").agg(F.sum(F.col("value").cast(kind)).alias("value"))
    per = added.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("all"))
    return {r.length: [v.value for v in r["all"]] for r in per.collect()}


def fit(rows: DataFrame, vector: str, components: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of the distinct grid vectors of ``rows``, one per length of vectors that occurs.

    Each different vector counts once, however often it is repeated. Directions without any spread, as of
    constant entries or of fewer vectors than entries, are no components. A
    table without usable vectors gives an empty dict. What reaches the driver per length is one count, the
    sums and a square matrix of that length.
    """
    bounded_batches(rows.sparkSession)
    distinct = whole_vectors(rows, vector).select(on_grid(F.col(vector)).alias("x")).distinct()
    distinct = materialize(distinct, "whitening-fit")
    totals = materialize(distinct.mapInArrow(_totals, "length int, n bigint, sums array<string>"), "whitening-sums")
    counts = {r.length: r.n for r in totals.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    sums = {k: [int(v) for v in found] for k, found in _summed(totals, "sums", "decimal(38,0)").items()}
    means = {k: (n, sums[k]) for k, n in counts.items()}

    def products(vectors: dict) -> dict[int, np.ndarray]:
        parts = distinct.mapInArrow(
            partial(_products, means=means, vectors=vectors), "length int, products array<double>"
        )
        wide = {k: vectors[k].shape[1] if k in vectors else k for k in means}
        return {k: np.reshape(v, (wide[k], wide[k])) / counts[k] for k, v in _summed(parts, "products", "double").items()}

    solved = {}
    for length, matrix in products({}).items():
        values, vectors = eigenvectors(matrix)
        kept = values[:components] > np.finfo(float).eps * 8 * length * max(values[0], 0)
        if kept.any():
            solved[length] = (matrix, values[:components][kept], vectors[:, :components][:, kept])
    scaled = {k: vectors / np.sqrt(values) for k, (_, values, vectors) in solved.items()}
    # lengths without a component need no second look
    checked = products({k: scaled.get(k, np.zeros((k, 0))) for k in means}) if solved else {}
    return {
        k: Whitening(
            counts[k],
            sums[k],
            vectors,
            values,
            values / float(np.trace(matrix.astype(np.longdouble))),
            float(np.abs(checked[k] - np.eye(len(values))).max()),
        )
        for k, (matrix, values, vectors) in solved.items()
    }


def _apply(parts: Iterator[pa.RecordBatch], models: dict[int, Whitening]) -> Iterator[pa.RecordBatch]:
    for batch in parts:
        for length, places, x in _grouped(batch, "x"):
            if length not in models:
                continue
            model = models[length]
            k = len(model.values)
            away = from_mean(x, model.n, model.sums)
            whitened = (away / model.n).astype(np.float64) @ (model.vectors / np.sqrt(model.values))
            if away.dtype == object or float(np.abs(away).max()) ** 2 * length >= _WHOLE:
                squares = [sum(int(v) ** 2 for v in row) for row in away]
                deviation = pa.array([v if v < 2**63 else None for v in squares], pa.int64())
            else:
                deviation = pa.array((away * away).sum(axis=1))
            each = pa.array(np.repeat(np.arange(len(places)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(places)).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(places))),
                    pa.array(np.full(len(places) * k, model.n)),
                    deviation.take(each),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(model.explained, len(places))),
                    pa.array(np.full(len(places) * k, model.identity_error)),
                ],
                names=[c.split()[0] for c in WHITENED.split(", ")],
            )


def whitened(rows: DataFrame, models: dict[int, Whitening], key: str, vector: str) -> DataFrame:
    """One row per usable row of ``rows`` and component of its length, with the row's ``key`` as ``id``.

    Repeated rows and rows without a key come out as often as they stand there. Rows whose vector is NULL,
    empty, or holds NULL or non-finite entries give none, as do lengths without a component.
    ``deviation`` is NULL where it exceeds a bigint.
    """
    bounded_batches(rows.sparkSession)
    x = whole_vectors(rows, vector).select(F.col(key).cast("bigint").alias("id"), on_grid(F.col(vector)).alias("x"))
    return x.mapInArrow(partial(_apply, models=models), WHITENED)
