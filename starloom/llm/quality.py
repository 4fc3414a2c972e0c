"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.support import bounded_batches

# At most this many labelled documents are read for the fit, the first in the order of a hash of the key.
FIT_DOCUMENTS = 6000
BUCKETS = 1 << 16
GRADES = 3
# A document is selected if a grade of at least SELECT_GRADE, the good one, is as likely as the model asks for.
SELECT_GRADE = 2
# Parts of the rated documents that are held out in turn to find that probability.
FOLDS = 4
# Share of the good held-out documents that it must keep.
CLEAN_SHARE = 0.95
ROUNDS = 150
RATE = 0.1
PENALTY = 2e-5


@dataclass(frozen=True)
class Model:
    """Weights shared by all grades, one rising threshold between each two grades, and the least probability of a
    good grade that selects a document."""

    weights: np.ndarray
    thresholds: np.ndarray
    least: float = 0.0

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """Probability of a grade above 0, above 1, ... per score."""
        return 1 / (1 + np.exp(self.thresholds - scores[:, None]))


def grade_of(quality: Column, toxic: Column) -> Column:
    """Rating of a labelled document: 0 poor, 1 well written but toxic, 2 good. NULL toxic counts as not toxic."""
    fine = F.when(F.coalesce(toxic, F.lit(0)) == 1, F.lit(1)).otherwise(F.lit(2))
    return F.when(quality == 0, F.lit(0)).when(quality == 1, fine)


def _bucket(word: str, kind: int) -> int:
    return xxhash.xxh32_intdigest(word.encode(), kind) % BUCKETS


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse hashed features of whole texts: document, bucket and value of each entry, and the words per text.

    Distinct lower-case words weigh one over the root of their number. Word shapes
    (runs of small letters, capitals and digits as ``a``, ``A`` and ``0``) and whether a word repeats
    the one before weigh their share of all words. NULL and empty texts have no entries.
    """
    words = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.list_flatten(words).dictionary_encode()
    codes, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    doc = np.repeat(np.arange(len(lengths)), lengths)
    real = np.asarray(pc.not_equal(names, "").to_numpy(zero_copy_only=False), bool)
    if not real.all():  # white space at either end of a text splits off empty words
        use = real[codes]
        doc, codes = doc[use], codes[use]
    count = np.bincount(doc, minlength=len(lengths))
    shape = names
    for runs, letter in (("[0-9]+", "0"), ("[a-zß-ÿ]+", "a"), ("[A-ZÀ-Þ]+", "A")):
        shape = pc.replace_substring_regex(shape, runs, letter)
    shapes = shape.dictionary_encode()
    shape_bucket = np.array([_bucket(x, 1) for x in shapes.dictionary.to_pylist()], np.int64)
    word_bucket = np.array([_bucket(x, 0) for x in pc.utf8_lower(names).to_pylist()], np.int64)
    same = np.zeros(len(codes), np.int64)
    same[1:] = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
    entries = []
    if len(codes):
        found = np.unique(doc * BUCKETS + word_bucket[codes])
        own = found // BUCKETS
        entries.append((own, found % BUCKETS, 1 / np.sqrt(np.bincount(own, minlength=len(lengths)))[own]))
        others = np.concatenate([shape_bucket[shapes.indices.to_numpy(zero_copy_only=False)][codes], same])
        twice = np.concatenate([doc, doc])
        others[len(codes) :] += _bucket("repeats", 2)
        found, times = np.unique(twice * BUCKETS + others % BUCKETS, return_counts=True)
        own = found // BUCKETS
        entries.append((own, found % BUCKETS, times / count[own]))
    joined = [np.concatenate(x) for x in zip(*entries)] if entries else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
    return *joined, count


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, bucket, value, count = features(batch.column("text"))
        order = np.argsort(doc, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(count)))]).astype(np.int32)
        lists = [pa.array(bucket[order].astype(np.int32)), pa.array(value[order].astype(np.float32))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("grade"), *[pa.ListArray.from_arrays(pa.array(ends), x) for x in lists]],
            ["grade", "buckets", "vals"],
        )


def rated(labels: DataFrame, key: str = "doc_id", limit: int = FIT_DOCUMENTS) -> DataFrame:
    """``(key, grade)`` of at most ``limit`` labelled documents; of several ratings the lowest holds."""
    graded = labels.select(F.col(key).alias("key"), grade_of(F.col("quality"), F.col("toxic")).alias("grade"))
    single = graded.where("key is not null and grade is not null").groupBy("key").agg(F.min("grade").alias("grade"))
    return single.orderBy(F.xxhash64("key"), "key").limit(limit)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", limit: int = FIT_DOCUMENTS) -> Model:
    """Fit on the rated documents: at most ``limit``, and one row per key, reach the driver, as hashed features."""
    bounded_batches(docs.sparkSession)
    wanted = rated(labels, key, limit)
    lean = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    # wanted holds at most ``limit`` keys
    chosen = lean.join(F.broadcast(wanted), "key").groupBy("key").agg(F.min("text").alias("text"), F.min("grade").alias("grade"))
    rows = chosen.select("grade", "text").mapInArrow(_sparse, "grade int, buckets array<int>, vals array<float>").toArrow()
    grade = rows["grade"].to_numpy().astype(np.int64)
    lengths = pc.list_value_length(rows["buckets"]).to_numpy()
    bucket = pc.list_flatten(rows["buckets"]).to_numpy()
    value = pc.list_flatten(rows["vals"]).to_numpy().astype(float)
    entries = np.repeat(np.arange(len(grade)), lengths), bucket, value
    return replace(fit_rows(grade, *entries), least=held_out_least(grade, *entries))


def held_out_least(grade: np.ndarray, doc: np.ndarray, bucket: np.ndarray, value: np.ndarray, folds: int = FOLDS) -> float:
    """Probability of SELECT_GRADE that parts the grades best, each document scored by a model that has not seen it.

    Best is the highest mean, over the grades, of the share on the right side, so that the many good
    documents do not outvote the few toxic ones, among those that keep CLEAN_SHARE of the good ones. Without documents on both sides nothing is known, and 0 rejects none.
    """
    good = grade >= SELECT_GRADE
    if good.all() or not good.any():
        return 0.0
    fold, chance = np.zeros(len(grade), np.int64), np.zeros(len(grade))
    for g in range(GRADES):  # each fold has its share of every grade
        fold[grade == g] = np.arange((grade == g).sum()) % folds
    for k in range(folds):
        seen = fold != k
        use, place = seen[doc], np.cumsum(seen) - 1
        model = fit_rows(grade[seen], place[doc[use]], bucket[use], value[use])
        score = np.bincount(doc, weights=value * model.weights[bucket], minlength=len(grade))
        chance[~seen] = model.tails(score[~seen])[:, SELECT_GRADE - 1]
    bounds = np.unique(chance)
    right = np.zeros(len(bounds) - 1)
    for g in np.unique(grade):
        below = np.searchsorted(np.sort(chance[grade == g]), bounds[1:]) / (grade == g).sum()
        right += 1 - below if g >= SELECT_GRADE else below
    kept = 1 - np.searchsorted(np.sort(chance[good]), bounds[1:]) / good.sum()
    right = right[kept >= CLEAN_SHARE]
    best = int(right.argmax()) if len(right) else -1
    return float(bounds[best : best + 2].mean()) if best >= 0 else 0.0


def fit_rows(grade: np.ndarray, doc: np.ndarray, bucket: np.ndarray, value: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Cumulative-link model by gradient steps on the mean likelihood.

    ``P(grade > k) = 1 / (1 + exp(threshold_k - score))`` with one score per document
    and rising thresholds. The thresholds begin at the observed shares of the grades, each
    counted once more than seen; without labels they stay there.
    """
    seen = np.bincount(grade, minlength=GRADES) + 1
    above = seen[::-1].cumsum()[::-1][1:] / seen.sum()
    start = np.log((1 - above) / above)
    weights, steps = np.zeros(BUCKETS), np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    moments = [np.zeros(BUCKETS + len(steps)) for _ in range(2)]
    for t in range(1, rounds + 1 if len(grade) else 1):
        thresholds = steps[0] + np.concatenate([[0], np.cumsum(np.exp(steps[1:]))])
        score = np.bincount(doc, weights=value * weights[bucket], minlength=len(grade))
        tail = 1 / (1 + np.exp(thresholds - score[:, None]))
        bounds = np.concatenate([np.ones((len(grade), 1)), tail, np.zeros((len(grade), 1))], axis=1)
        slope = bounds * (1 - bounds)
        here = np.arange(len(grade))
        chance = np.maximum(bounds[here, grade] - bounds[here, grade + 1], 1e-12)
        by_score = -(slope[here, grade] - slope[here, grade + 1]) / chance / len(grade)
        by_bound = np.zeros(GRADES - 1)
        for k in range(GRADES - 1):
            by_bound[k] = (
                (slope[:, k + 1] / chance * (grade == k + 1)) - (slope[:, k + 1] / chance * (grade == k))
            ).sum() / len(grade)
        by_step = np.array([by_bound[k:].sum() * (np.exp(steps[k]) if k else 1) for k in range(GRADES - 1)])
        by_weight = np.bincount(bucket, weights=value * by_score[doc], minlength=BUCKETS) + PENALTY * weights
        gradient = np.concatenate([by_weight, by_step])
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        move = RATE * (moments[0] / (1 - 0.9**t)) / (np.sqrt(moments[1] / (1 - 0.99**t)) + 1e-8)
        weights, steps = weights - move[:BUCKETS], steps - move[BUCKETS:]
    thresholds = steps[0] + np.concatenate([[0], np.cumsum(np.exp(steps[1:]))])
    return Model(weights.astype(np.float32), thresholds)


def _score(batches: Iterator[pa.RecordBatch], model: Model, grade: int, least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, bucket, value, count = features(batch.column("text"))
        score = np.bincount(doc, weights=value * model.weights[bucket], minlength=len(count))
        tails = model.tails(score) * (count > 0)[:, None]
        tail = tails[:, grade - 1]
        rest = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*batch.select(rest).columns, pa.array(tails.sum(axis=1)), pa.array(tail), pa.array((tail >= least) & (count > 0))],
            [*rest, "expected_grade", "tail_probability", "selected"],
        )


def graded(
    docs: DataFrame,
    model: Model,
    keys: list[str],
    text: str = "text",
    grade: int = SELECT_GRADE,
    least: float | None = None,
) -> DataFrame:
    """``keys`` of every document with ``expected_grade``, ``tail_probability`` and ``selected``.

    ``tail_probability`` is that of a grade of at least ``grade``; ``least`` of it selects, by default what the
    model found on held-out labels. Whole texts are scored. A
    text without words, NULL included, has grade 0 for sure. Repeated rows get the same answer each; an empty table
    gives no rows; other columns do not matter.
    """
    bounded_batches(docs.sparkSession)
    lean = docs.select(*keys, F.col(text).alias("text")) if text not in keys else docs.select(*keys)
    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{kinds}, expected_grade double, tail_probability double, selected boolean"
    least = model.least if least is None else least
    return lean.mapInArrow(partial(_score, model=model, grade=grade, least=least), schema)


def _select(batches: Iterator[pa.RecordBatch], model: Model, text: str, grade: int, least: float):
    for batch in batches:
        doc, bucket, value, count = features(batch.column(batch.schema.names.index(text)))
        score = np.bincount(doc, weights=value * model.weights[bucket], minlength=len(count))
        yield batch.filter(pa.array((model.tails(score)[:, grade - 1] >= least) & (count > 0)))


def selected(
    docs: DataFrame, model: Model, text: str = "text", grade: int = SELECT_GRADE, least: float | None = None
) -> DataFrame:
    """The documents that the model selects, under their own columns, in one pass without a shuffle."""
    bounded_batches(docs.sparkSession)
    least = model.least if least is None else least
    return docs.mapInArrow(partial(_select, model=model, text=text, grade=grade, least=least), docs.schema)
