"""Near-duplicates by SimHash: a byte-position inverted index with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import connected_components
from starloom.llm.support import FILE, PLACE, bounded_batches, hex_of, keep_located, located
from starloom.operators.joins import dim_join
from starloom.session import materialize

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
POSITIONS = 8  # a 64-bit fingerprint is eight bytes
# Bytes that one posting key holds together: the lists stay short up to billions of fingerprints.
KEY_BYTES = 4
# A posting list longer than this is told apart by longer keys.
LIST_ROWS = 2000
LIST = ["mask", "bits"]
_HASHES_AT_ONCE = 1 << 16


def fingerprint(data: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash of a UTF-8 text as a signed 64-bit number; zero for a text without words."""
    # bytes.lower() and bytes.split() change and split at ASCII letters and white space only
    parts = (data or b"").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(joined)]
    width = min(words, len(parts))
    spans = zip(starts, ends[width - 1 :])
    view = memoryview(joined)
    digest = xxhash.xxh64_intdigest
    total, ones = len(parts) - width + 1, np.zeros(64, np.int64)
    for begin in range(0, total, _HASHES_AT_ONCE):
        here = min(_HASHES_AT_ONCE, total - begin)
        hashes = np.fromiter((digest(view[s:e], SEED) for s, e in _take(spans, here)), ">u8", here)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(here, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total).view(">i8")[0])


def _take(spans: Iterator, count: int) -> Iterator:
    for _, span in zip(range(count), spans):
        yield span


def _fingerprints(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = batch.column("text").cast(pa.large_binary()).to_pylist()
        prints = pa.array([fingerprint(x, words) for x in data], pa.int64())
        rest = batch.select([n for n in batch.schema.names if n != "text"])
        yield pa.RecordBatch.from_arrays([*rest.columns, prints], [*rest.schema.names, "fp"])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with its ``text`` replaced by ``fp``, the fingerprint of the whole text."""
    bounded_batches(docs.sparkSession)
    rest = docs.drop("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return docs.mapInArrow(partial(_fingerprints, words=words), f"{schema}, fp bigint")


def shared_bytes(a: Column, b: Column) -> Column:
    """In how many of the eight positions both fingerprints hold the same byte."""
    differ = a.bitwiseXOR(b)
    same = [F.shiftright(differ, 8 * i).bitwiseAND(255) == 0 for i in range(POSITIONS)]
    return reduce(lambda x, y: x + y, [s.cast("int") for s in same])


def _mask(units: tuple[int, ...], width: int) -> int:
    """The signed 64-bit number whose bits are set in these units of ``width`` bits."""
    mask = sum(((1 << width) - 1) << (width * i) for i in units)
    return mask - (1 << 64) if mask >> 63 else mask


def key_masks(max_bits: int) -> list[list[int]]:
    """Masks of the posting keys, three levels from short to long keys.

    At most ``max_bits`` bytes differ, so among the first ``size + max_bits``
    positions at least ``size`` agree, and among all eight at least ``8 - max_bits``. Of the
    ``2 * max_bits`` half bytes that are then left, at least ``max_bits`` agree. Partners therefore share the bits
    of at least one mask on each level, and one on the next level that holds it.
    """
    size = min(KEY_BYTES, POSITIONS - max_bits)
    first = [_mask(c, 8) for c in combinations(range(size + max_bits), size)]
    whole = list(combinations(range(POSITIONS), POSITIONS - max_bits))
    rest = [[h for i in range(POSITIONS) if i not in c for h in (2 * i, 2 * i + 1)] for c in whole]
    halves = {_mask(c, 8) | _mask(h, 4) for c, r in zip(whole, rest) for h in combinations(r, max_bits)}
    return [first, [_mask(c, 8) for c in whole], sorted(halves)]


def _under(rows: DataFrame, masks: list[int], shorter: Column | None = None) -> DataFrame:
    """``(mask, bits, fp)``: each fingerprint under every mask, or every one that holds the ``shorter`` mask."""
    kept = F.lit(masks).cast("array<bigint>")
    if shorter is not None:
        kept = F.filter(kept, lambda m: m.bitwiseAND(shorter) == shorter)
    spread = rows.select("fp", F.explode(kept).alias("mask"))
    return spread.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"), "fp")


def posting_lists(prints: DataFrame, max_bits: int, list_rows: int = LIST_ROWS) -> DataFrame:
    """``(mask, bits, fp)``: an inverted index in which partners share at least one list.

    A list of more than ``list_rows`` fingerprints is replaced by lists under longer keys: first all bytes that partners
    must share, then half bytes as well. The last leave ``4 * max_bits`` bits open, 256 fingerprints for two bits,
    so the rows of a list are bounded however many fingerprints share bytes.
    """
    first, *longer = key_masks(max_bits)
    open_lists, done = _under(prints, first), []
    for masks in longer:
        counted = open_lists.groupBy(*LIST).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > list_rows)
        too_long = materialize(counted.select(*LIST), "long-lists")
        if too_long.isEmpty():
            break
        done.append(dim_join(open_lists, too_long, LIST, "left_anti"))
        rows = dim_join(open_lists, too_long, LIST, "left_semi")
        # several short keys lead to the same longer one
        open_lists = materialize(_under(rows, masks, F.col("mask")).distinct(), "longer-keys")
    return reduce(DataFrame.unionAll, [*done, open_lists])


def close_fingerprints(prints: DataFrame, max_bits: int = MAX_BITS, list_rows: int = LIST_ROWS) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of distinct fingerprints ``fp`` that differ in 1 to ``max_bits`` bits; all of them.

    Inverted index over positional bytes. Fingerprints that meet in a list
    have their shared positional bytes tallied; a pair below the guaranteed
    ``8 - max_bits`` goes, the rest is verified by counting bits. Lists stay
    below a fixed length (``posting_lists``), so the pairs that meet grow with the fingerprints.
    """
    if not 1 <= max_bits < POSITIONS:
        raise ValueError("the index needs a distance from 1 to 7 bits")
    lists = posting_lists(prints, max_bits, list_rows)
    met = lists.withColumnRenamed("fp", "a").join(lists.withColumnRenamed("fp", "b"), LIST).where("a < b")
    tallied = met.where(shared_bytes(F.col("a"), F.col("b")) >= POSITIONS - max_bits)
    verified = tallied.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).between(1, max_bits))
    return verified.select("a", "b").distinct()


def near_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: fingerprint, component and whether it is the one that stays.

    Returns ``key``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest key reachable over links), ``kept``
    and the columns of ``located``. Equal fingerprints are one class and link without being paired; NULL and empty texts
    have fingerprint zero. NULL keys count as largest: ``component_id`` is NULL only if the whole component has
    none. Of rows that share the smallest key, the first by file and place is
    kept. An empty table gives no rows; other columns do not matter.
    """
    lean = located(docs).select(F.col(key).alias("key"), F.col(text).alias("text"), FILE, PLACE)
    prints = materialize(fingerprints(lean, words), "fingerprints")
    first = F.struct(F.col("key").isNull(), "key", FILE, PLACE)
    classes = materialize(prints.groupBy("fp").agg(F.min(first).alias("first")), "classes")
    linked = connected_components(close_fingerprints(classes.select("fp"), max_bits))
    joined = materialize(
        classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first", F.coalesce("component", "fp").alias("component")
        ),
        "linked",
    )
    lowest = joined.groupBy("component").agg(F.min("first").alias("first"))
    found = materialize(joined.drop("first").join(lowest, "component").select("fp", "first"), "found")
    stays = (F.col(FILE) == F.col(f"first.{FILE}")) & (F.col(PLACE) == F.col(f"first.{PLACE}"))
    return prints.join(found, "fp").select(
        F.col("key").alias(key),
        hex_of(F.col("fp")).alias("fingerprint"),
        F.col("first.key").alias("component_id"),
        stays.alias("kept"),
        FILE,
        PLACE,
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row per component of close fingerprints; the columns stay as they are."""
    placed = located(docs)
    return keep_located(placed, near_groups(placed, key, text).where("kept"))
