"""Exact ranked search: a forest of ball trees over sparse term vectors, searched best-first per query.

The score of a document is the inner product of two vectors over terms: how often the query holds a term,
and the term's weight times its impact in the document. A ball of documents with centre ``c`` and radius
``r`` holds none that scores more than ``q.c + |q'| r``, where ``q'`` is the part of the query whose terms occur
in the ball, so subtrees whose bound, rounded up, stays below the k-th best score so far are never opened.
Leaves are scored in whole numbers.

Only the terms that some query holds can add to a score, so only these enter vectors and document counts.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.support import bounded_batches
from starloom.session import materialize

BEST = 10
# Text of the queries that one pass over the documents answers; more queries take more passes.
QUERY_BYTES = 4 << 20
# Documents of one tree, and entries of their vectors: what a task holds at a time.
TREE_DOCUMENTS, TREE_ENTRIES = 4096, 1 << 21
LEAF_DOCUMENTS = 32

# Everything in ASCII but digits and letters separates terms; letters become lower case.
_TERMS = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256)
)
_INDEX = pa.schema(
    [("doc", pa.int64()), ("size", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))]
)
INDEX = "doc bigint, size bigint, terms array<int>, counts array<bigint>"
_FOUND = pa.schema([("query", pa.int32()), ("doc", pa.int64()), ("score", pa.int64())])
FOUND = "query int, doc bigint, score bigint"


def terms_of(text: str | bytes | None) -> list[bytes]:
    """The terms of a whole text in UTF-8, in their order; none for NULL."""
    raw = text.encode() if isinstance(text, str) else text or b""
    return raw.translate(_TERMS).split()


@dataclass(frozen=True)
class Queries:
    """Queries over a shared vocabulary: term numbers and how often each query holds them."""

    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]
    counts: list[np.ndarray]


def as_queries(texts: list[str | None]) -> Queries:
    vocabulary: dict[bytes, int] = {}
    terms, counts = [], []
    for text in texts:
        found = Counter(terms_of(text))
        terms.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in found], dtype=np.int32))
        counts.append(np.array(list(found.values()), dtype=np.int64))
    return Queries(vocabulary, terms, counts)


def _index(parts: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Number of terms of each document with any, and its counts of the terms in ``vocabulary``."""
    for batch in parts:
        rows = []
        for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").cast(pa.binary())):
            words = terms_of(text.as_py())
            if words:
                found = sorted((vocabulary[w], n) for w, n in Counter(words).items() if w in vocabulary)
                rows.append((doc, len(words), [t for t, _ in found], [n for _, n in found]))
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _INDEX)], schema=_INDEX)


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(counts: np.ndarray, sizes: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What one unit of term weight is worth in a document, in whole numbers."""
    length = 100 - 75 + (75 * sizes * documents) // total
    return (1_000_000_000 * counts) // (1000 * counts + 8 * length)


class BallTree:
    """Documents as sparse rows, halved around two far ones until a leaf holds few.

    Bounds use values scaled by the square root of the term weight on both sides, which leaves the inner
    product as it is. Documents with the same vector are one row; ``docs`` lists the first ``best`` of each
    row in ascending order (``None`` last), and no other of them can be among the best.
    """

    def __init__(self, rows: list[tuple[int | None, np.ndarray, np.ndarray]], weights: np.ndarray, best: int):
        same: dict[bytes, list] = {}
        for doc, terms, values in rows:
            same.setdefault(terms.tobytes() + values.tobytes(), [terms, values, []])[2].append(doc)
        rows_of = list(same.values())
        self.docs = [sorted(docs, key=_doc_order)[:best] for _, _, docs in rows_of]
        lengths = [len(terms) for terms, _, _ in rows_of]
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.terms = np.concatenate([terms for terms, _, _ in rows_of])
        self.values = np.concatenate([values for _, values, _ in rows_of])
        self.scaled = self.values * np.sqrt(weights)[self.terms]
        self.norms = np.add.reduceat(self.scaled**2, self.starts[:-1])
        self.width = len(weights)
        self._scratch = np.zeros(self.width)
        # left and right of each node, or its rows with their terms, values and starts; centre (sparse) and radius
        self.nodes: list[tuple[int, int, tuple | None]] = []
        self.centers: list[tuple[np.ndarray, np.ndarray]] = []
        self.radii: list[float] = []
        self._grow(np.arange(len(rows_of)))

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the entries of ``rows``, start of each row among them)."""
        sizes = self.starts[rows + 1] - self.starts[rows]
        starts = np.cumsum(sizes) - sizes
        return np.arange(sizes.sum()) + np.repeat(self.starts[rows] - starts, sizes), starts

    def _dots(self, entries: np.ndarray, starts: np.ndarray, terms, values) -> np.ndarray:
        """Inner products of the rows of ``entries`` with a sparse point."""
        self._scratch[terms] = values
        dots = np.add.reduceat(self.scaled[entries] * self._scratch[self.terms[entries]], starts)
        self._scratch[terms] = 0
        return dots

    def _squared(self, rows: np.ndarray, entries: np.ndarray, starts: np.ndarray, terms, values) -> np.ndarray:
        """Squared distances of ``rows`` from a sparse point, never below the true ones.

        A sum of m rounded products is off by at most m units in the last place of the sum of their sizes.
        """
        dots = self._dots(entries, starts, terms, values)
        own = float(values @ values)
        slack = (self.norms[rows] + own) * (8 + self.width) * 2.0**-50
        return np.maximum(self.norms[rows] + own - 2 * dots, 0) + slack

    def _center(self, rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = np.bincount(self.terms[entries], self.scaled[entries], self.width)
        terms = np.flatnonzero(sums)
        return terms, sums[terms] / len(rows)

    def _grow(self, all_rows: np.ndarray) -> None:
        waiting = [(all_rows, -1, 0)]
        while waiting:
            rows, parent, side = waiting.pop()
            entries, starts = self._entries(rows)
            center = self._center(rows, entries)
            squares = self._squared(rows, entries, starts, *center)
            node = len(self.nodes)
            self.centers.append(center)
            self.radii.append(float(np.sqrt(squares.max())) * (1 + 2.0**-50))
            leaf = len(rows) <= LEAF_DOCUMENTS
            self.nodes.append((-1, -1, (rows, self.terms[entries], self.values[entries], starts) if leaf else None))
            if parent >= 0:
                left, right, _ = self.nodes[parent]
                self.nodes[parent] = (node, right, None) if side == 0 else (left, node, None)
            if leaf:
                continue
            far = self._point(rows[squares.argmax()])
            near = self._dots(entries, starts, *far)
            from_far = self.norms[rows] - 2 * near
            other = self._dots(entries, starts, *self._point(rows[from_far.argmax()]))
            # the half nearer to one of them; by rank, so that both halves shrink whatever the spread. Rows that
            # share no term with either are exactly even, which their distances would be up to rounding only
            order = np.lexsort((self.terms[entries[starts]], other - near))
            half = len(rows) // 2
            waiting += [(rows[order[:half]], node, 0), (rows[order[half:]], node, 1)]

    def _point(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.starts[row], self.starts[row + 1])
        return self.terms[at], self.scaled[at]

    def search(self, terms, counts, weights: np.ndarray, heap: list, best: int) -> int:
        """Offer this tree's documents to ``heap`` of the ``best`` so far; the number of rows that were scored.

        Subtrees are opened by falling bound. One whose bound equals the worst score of the heap is opened,
        because of two equal scores the smaller document wins.
        """
        scaled = counts * np.sqrt(weights[terms])
        exact = np.zeros(self.width, dtype=np.int64)
        exact[terms] = counts * weights[terms]
        dense = np.zeros(self.width)
        dense[terms] = scaled

        def bound(node: int) -> float:
            at, values = self.centers[node]
            asked = dense[at]
            most = float(asked @ values) + math.sqrt(float(asked @ asked)) * self.radii[node]
            # sums of n entries, none negative, are off by at most n units in their last place
            return most * (1 + (16 + len(at)) * 2.0**-50) + 1

        scored, waiting = 0, [(-bound(0), 0)]
        while waiting:
            below, node = heapq.heappop(waiting)
            if len(heap) == best and -below < heap[0][0]:
                break
            left, right, leaf = self.nodes[node]
            if leaf is None:
                for child in (left, right):
                    heapq.heappush(waiting, (-bound(child), child))
                continue
            rows, at, values, starts = leaf
            scores = np.add.reduceat(exact[at] * values, starts)
            scored += len(rows)
            least = heap[0][0] if len(heap) == best else 1
            for place in np.flatnonzero(scores >= least):
                for doc in self.docs[rows[place]]:
                    offer(heap, int(scores[place]), doc, best)
        return scored


def _doc_order(doc: int | None) -> tuple[bool, int]:
    return (doc is None, doc or 0)


def offer(heap: list, score: int, doc: int | None, best: int) -> None:
    """Keep the ``best`` highest scores, of equal ones the smallest documents; the worst one lies on top."""
    missing, number = _doc_order(doc)
    entry = (score, not missing, -number)
    if score > 0 and len(heap) < best:
        heapq.heappush(heap, entry)
    elif score > 0 and entry > heap[0]:
        heapq.heapreplace(heap, entry)


def _search(
    parts: Iterator[pa.RecordBatch], queries: Queries, weights: np.ndarray, documents: int, total: int, best: int
) -> Iterator[pa.RecordBatch]:
    """The best documents of a task for each query, tree by tree under one running threshold."""
    heaps: list[list] = [[] for _ in queries.terms]

    def answer(rows: list) -> None:
        tree = BallTree(rows, weights, best)
        for terms, counts, heap in zip(queries.terms, queries.counts, heaps):
            if len(terms):
                tree.search(terms, counts, weights, heap, best)

    rows, entries = [], 0
    for batch in parts:
        lists = batch.column("terms")
        ends = np.cumsum(np.asarray(lists.value_lengths()))
        terms, counts = np.asarray(lists.flatten()), np.asarray(batch.column("counts").flatten())
        sizes = np.asarray(batch.column("size"))
        values = impacts(counts, np.repeat(sizes, np.diff(ends, prepend=0)), documents, total)
        worth = weights[terms] > 0
        for doc, start, end in zip(batch.column("doc").to_pylist(), np.concatenate([[0], ends]), ends):
            kept = np.flatnonzero(worth[start:end]) + start
            if not len(kept):
                continue  # scores 0 for every query
            rows.append((doc, terms[kept], values[kept]))
            entries += len(kept)
            if len(rows) >= TREE_DOCUMENTS or entries >= TREE_ENTRIES:
                answer(rows)
                rows, entries = [], 0
    if rows:
        answer(rows)
    out = [(q, -number if there else None, score) for q, heap in enumerate(heaps) for score, there, number in heap]
    columns = list(zip(*out)) or [[]] * 3
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)


def _blocks(queries: DataFrame, key: str, text: str) -> Iterator[list[tuple]]:
    """(key, text) of the queries in blocks of bounded text; one query is one row of a block."""
    block, held = [], 0
    for row in queries.select(F.col(key).cast("bigint"), F.col(text)).toLocalIterator():
        block.append(tuple(row))
        held += 64 + len((row[1] or "").encode())
        if held >= QUERY_BYTES:
            yield block
            block, held = [], 0
    if block:
        yield block


def _block_found(docs: DataFrame, texts: list[str | None], best: int) -> DataFrame | None:
    """(query, doc, score) with at least the ``best`` of each query, ``query`` being its place in ``texts``."""
    queries = as_queries(texts)
    index = docs.mapInArrow(partial(_index, vocabulary=queries.vocabulary), INDEX)
    index = materialize(index, "lexical-index")
    documents, total = index.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    if not documents:
        return None
    held = index.select(F.explode("terms").alias("term")).groupBy("term").count()
    # one number per term of this block of queries
    weights = np.full(len(queries.vocabulary), term_weight(documents, 0), dtype=np.int64)
    for term, n in held.collect():
        weights[term] = term_weight(documents, n)
    run = partial(_search, queries=queries, weights=weights, documents=documents, total=total, best=best)
    return index.mapInArrow(run, FOUND)


def ranked(
    docs: DataFrame, queries: DataFrame, doc_key: str, doc_text: str, query_key: str, query_text: str, best: int = BEST
) -> DataFrame:
    """``(item, rank, doc, score)``: the ``best`` documents of each query with a score above 0, best first.

    Every row of ``docs`` is a document of its own and every row of ``queries`` a query of its own, repeated
    rows and rows without a key included; a document without a key comes after equally scored ones. NULL
    and term-free texts neither find nor are found. Tasks hand on at most ``best`` documents per
    query, and these meet per query in a ranking that is cut to ``best`` before and after the shuffle.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col(doc_key).cast("bigint").alias("doc"), F.col(doc_text).alias("text"))
    answers = []
    for block in _blocks(queries, query_key, query_text):
        found = _block_found(docs, [text for _, text in block], best)
        if found is None:
            break
        names = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(block)], "query int, item bigint")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
        answers.append(materialize(top.join(F.broadcast(names), "query").select("item", "rank", "doc", "score"), "ranked"))
    if not answers:
        return spark.createDataFrame([], "item bigint, rank int, doc bigint, score bigint")
    result = answers[0]
    for answer in answers[1:]:
        result = result.unionAll(answer)
    return result


SQL = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes),
weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM counts, corpus GROUP BY term, docs
), asked AS (
    SELECT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (doc_id), corpus
    GROUP BY item_id, doc_id
)
SELECT item_id, rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
) WHERE rank <= 10
"""
