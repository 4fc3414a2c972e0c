"""Near-duplicate vectors: blocks of vectors meet in place, leading coordinates of a rotation preselect pairs."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from starloom.llm.components import connected_components
from starloom.llm.support import bounded_batches
from starloom.session import materialize

LEAST_COSINE = 0.95
# The first of so many parts of a rotated vector preselects pairs, but at least LEAD coordinates.
BLOCKS = 4
LEAD = 24
# Vectors and bytes that one block holds at most; a pair of blocks meets in one step of a task.
CHUNK = 1 << 16
BLOCK_BYTES = 16 << 20
SEED = 11
_TILE = 512  # rows and columns of the distances looked at together inside a task
_PORTION = 1 << 15  # pairs handed on together
# Tasks, and so files of links, at most.
_TASKS = 10_000
# Blocks in a row group: bounds what writers and readers hold.
_ROW_GROUP = {"parquet.block.row.count.limit": "2"}

_HELD = ["cls", "copies", "low", "name"]
FOUND = "cls bigint, links bigint, other bigint"
_FOUND = pa.schema([("cls", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])


def usable(vector: Column) -> Column:
    """True for vectors with a direction: not NULL, no NULL or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


@lru_cache(8)
def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """A fixed orthogonal matrix that spreads any distance over all coordinates."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dims]).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def named(vector: Column) -> Column:
    """16 bytes of the SHA-256 of a vector's text; equal vectors have one name, 0.0 being equal to -0.0."""
    text = F.regexp_replace(vector.cast("string"), r"-0\.0([,\]])", "0.0$1")
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def _pack(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Blocks of vectors of one length, a row each, in the order they come in."""

    def block(table: pa.Table, dims: int) -> pa.RecordBatch:
        ends = pa.array([0, table.num_rows], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, table[c].combine_chunks()) for c in _HELD]
        vectors = table["vector"].combine_chunks().flatten().to_numpy().tobytes()
        values = [pa.array([dims], pa.int32()), table["cls"].combine_chunks()[:1], *lists, pa.array([vectors], pa.binary())]
        return pa.RecordBatch.from_arrays(values, ["dims", "first", *_HELD, "vectors"])

    held: dict[int, list] = defaultdict(list)
    for batch in batches:
        lengths = batch.column("vector").value_lengths().to_numpy()
        for dims in np.unique(lengths).tolist():
            held[dims].append(batch.take(pa.array(np.flatnonzero(lengths == dims))))
            most = _block_rows(rows, dims, batch.column("vector").type.value_type)
            if sum(part.num_rows for part in held[dims]) >= most:
                table = pa.Table.from_batches(held[dims])
                whole = table.num_rows // most * most
                for at in range(0, whole, most):
                    yield block(table.slice(at, most), dims)
                held[dims] = table.slice(whole).to_batches()
    for dims, parts in held.items():
        if parts:
            yield block(pa.Table.from_batches(parts), dims)


def _block_rows(rows: int, dims: int, kind: pa.DataType) -> int:
    return max(1, min(rows, BLOCK_BYTES // (dims * kind.bit_width // 8)))


def _units(vectors: bytes, dims: int, kind: str) -> np.ndarray:
    x = np.frombuffer(vectors, kind).reshape(-1, dims).astype(float)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _joined(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``labels`` (each a smaller index of the same group) after joining the groups of ``i`` and ``j``."""
    while True:
        while not np.array_equal(higher := labels[labels], labels):
            labels = higher
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return labels
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))


def _linked(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of rows are linked.

    Sums run coordinate by coordinate: they come out the same in whatever task a pair is looked at.
    """
    dot = np.zeros(len(x))
    for d in range(x.shape[1]):
        dot += x[:, d] * y[:, d]
    return dot >= least


def linked_pairs(left: np.ndarray, right: np.ndarray, least: float, blocks: int, same: bool) -> Iterator[tuple]:
    """Rows ``(i, j)`` of unit vectors whose cosine is at least ``least``, in portions; of one block with itself only ``i < j``.

    Unit vectors of cosine c are ``2 - 2c`` apart, squared, and no further apart in the leading
    coordinates of a rotation: these, then whole vectors, are compared in single precision with room for its
    rounding, and only what is too close to call is decided in double precision.
    """
    dims = left.shape[1]
    room = (dims + 8) * 2.0**-23
    lead = rotation(dims)[: min(dims, max(LEAD, -(-dims // blocks)))].T
    a, b = (left @ lead).astype(np.float32), (right @ lead).astype(np.float32)
    # one product gives the squared distances: (-2x, |x|^2, 1) by (y, 1, |y|^2)
    a = np.column_stack([-2 * a, (a * a).sum(axis=1), np.ones(len(a), np.float32)])
    b = np.column_stack([b, np.ones(len(b), np.float32), (b * b).sum(axis=1)])
    b = [(at, b[at : at + _TILE].T.copy()) for at in range(0, len(b), _TILE)]
    single, other = left.astype(np.float32), right.astype(np.float32)
    most = np.float32(2 - 2 * least + 4 * room)
    held: list[tuple] = []
    for top in range(0, len(a), _TILE):
        strip = a[top : top + _TILE]
        for at, tile in b:
            if same and at + tile.shape[1] <= top:
                continue
            close = strip @ tile <= most
            i, j = np.nonzero(close) if close.size % 8 else _hits(close)
            if same:
                i, j = i[ahead := top + i < at + j], j[ahead]
            if not len(i):
                continue
            if 32 * len(i) > close.size:
                dots = (single[top : top + _TILE] @ other[at : at + _TILE].T)[i, j]
                i, j = i + top, j + at
            else:
                i, j = i + top, j + at
                dots = np.einsum("ij,ij->i", single[i], other[j])
            sure = dots >= least + room
            near, step = np.flatnonzero(~sure & (dots >= least - room)), max(1, (1 << 21) // dims)
            for k in (near[n : n + step] for n in range(0, len(near), step)):
                sure[k] = _linked(left[i[k]], right[j[k]], least)
            if sure.any():
                held.append((i[sure], j[sure]))
                if sum(len(part) for part, _ in held) >= _PORTION:
                    yield tuple(map(np.concatenate, zip(*held)))
                    held = []
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _hits(close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.nonzero`` that looks at eight cells at a time: hardly any is true."""
    words = np.flatnonzero(close.reshape(-1).view(np.uint64))
    at = (words[:, None] * 8 + np.arange(8)).ravel()
    return np.divmod(at[close.reshape(-1)[at]], close.shape[1])


def _compare(batches: Iterator[pa.RecordBatch], least: float, blocks: int, kind: str) -> Iterator[pa.RecordBatch]:
    """Links between the two blocks of a row: degrees, and a forest that connects the same vectors."""
    for batch in batches:
        for at in range(batch.num_rows):
            cls, copies, others, more = (
                batch.column(c)[at].values.to_numpy() for c in ("cls", "copies", "other_cls", "other_copies")
            )
            dims, same = batch.column("dims")[at].as_py(), cls[0] == others[0]
            left = _units(batch.column("vectors")[at].as_buffer(), dims, kind)
            right = left if same else _units(batch.column("other_vectors")[at].as_buffer(), dims, kind)
            shift = 0 if same else len(cls)
            if not same:
                cls, copies = np.concatenate([cls, others]), np.concatenate([copies, more])
            links, labels = np.zeros(len(cls), np.int64), np.arange(len(cls))
            for i, j in linked_pairs(left, right, least, blocks, bool(same)):
                j = j + shift
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                labels = _joined(labels, i, j)
            found = np.flatnonzero(links)
            values = [pa.array(x) for x in (cls[found], links[found], cls[labels[found]])]
            yield pa.RecordBatch.from_arrays(values, schema=_FOUND)


def packed(classes: DataFrame, rows: int = CHUNK) -> DataFrame:
    """``(cls, vector, copies, low, name)`` as blocks of at most ``rows`` vectors of one length, a row each."""
    bounded_batches(classes.sparkSession)
    kinds = {c: classes.schema[c].dataType.simpleString() for c in _HELD}
    schema = ["dims int", "first bigint", *(f"{c} array<{kind}>" for c, kind in kinds.items()), "vectors binary"]
    blocks = classes.select(*_HELD, "vector").mapInArrow(partial(_pack, rows=rows), ", ".join(schema))
    return materialize(blocks, "blocks", **_ROW_GROUP)


def block_pairs(blocks: DataFrame) -> DataFrame:
    """Every two blocks of one length, and each block with itself, once.

    No column is equal on both sides, so the join is Spark's Cartesian product: a task reads
    two portions of the table and nothing is shuffled or copied to disk.
    A hash says which block of two comes first, which spreads the pairs over the tasks.
    """
    own = ["dims", "first", "cls", "copies", "vectors"]
    left, right = blocks.select(*own), blocks.select(*(F.col(c).alias(f"other_{c}") for c in own))
    one, two = F.col("first"), F.col("other_first")
    odd = F.pmod(F.xxhash64(F.least(one, two), F.greatest(one, two)), F.lit(2)) == 1
    # not an equality: all blocks of the usual length would meet in one task
    alike = (F.col("dims") <= F.col("other_dims")) & (F.col("dims") >= F.col("other_dims"))
    return left.join(right, alike & ((one == two) | (one < two) & odd | (one > two) & ~odd))


def linked_classes(blocks: DataFrame, kind: str, least: float = LEAST_COSINE, parts: int = BLOCKS) -> DataFrame:
    """``(cls, links, other)`` for the ``packed`` distinct vectors, of numpy's ``kind``.

    ``links`` of a class sum up to the copies of the classes it is linked with;
    ``other`` connects it to a class of the same component. Every pair of vectors
    is in one pair of blocks, so it is counted once, without a shuffle of vectors or of pairs.
    """
    pairs = block_pairs(blocks).drop("first", "other_first", "other_dims").coalesce(_TASKS)
    return materialize(pairs.mapInArrow(partial(_compare, least=least, blocks=parts, kind=kind), FOUND), "links")


def near_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    least: float = LEAST_COSINE,
    blocks: int = BLOCKS,
    rows: int = CHUNK,
) -> DataFrame:
    """One row per vector: ``key``, ``n_links``, ``component_id`` and ``kept``.

    Vectors link if their cosine, in double precision, is at least ``least``. Equal
    vectors are one class and link without being paired. A vector that is NULL,
    empty, zero or holds a NULL or non-finite component links with nothing, and only
    vectors of one length are compared. ``component_id`` is the smallest
    key reachable, NULL only if no vector of the component has a key; ``kept``
    compares it with the key, NULL equal to NULL. Repeated rows count one by
    one. An empty table gives no rows; other columns do not matter.
    """
    single = isinstance(vectors.schema[vector].dataType.elementType, FloatType)
    given = F.col(vector) if single else F.col(vector).cast("array<double>")
    lean = vectors.select(F.col(key).alias("key"), given.alias("vector"))
    good = lean.where(usable(F.col("vector"))).withColumn("name", named(F.col("vector")))
    grouped = good.groupBy("name", "vector").agg(F.min("key").alias("low"), F.count(F.lit(1)).alias("copies"))
    packs = packed(grouped.withColumn("cls", F.monotonically_increasing_id()), rows)
    found = linked_classes(packs, "<f4" if single else "<f8", least, blocks)
    # from here on rows carry names, no vectors
    classes = packs.select(F.inline(F.arrays_zip(*_HELD)))
    sums = found.groupBy("cls").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("cls").alias("a"), F.col("other").alias("b")).where("a <> b")
    groups = connected_components(edges).withColumnRenamed("node", "cls")
    labelled = materialize(
        classes.join(sums, "cls", "left")
        .join(groups, "cls", "left")
        .select(
            "name",
            "low",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "cls").alias("component"),
        ),
        "labelled",
    )
    lowest = labelled.groupBy("component").agg(F.min("low").alias("component_id"))
    answers = materialize(labelled.drop("low").join(lowest, "component").drop("component"), "answers")
    alone = lean.where(~usable(F.col("vector"))).select(
        "key", F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component_id")
    )
    rows_out = good.select("key", "name").join(answers, "name").select("key", "n_links", "component_id").unionByName(alone)
    return rows_out.select(
        F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept")
    )
