"""Language-model scoring by cross-entropy difference over pairs of pieces of a public tokenizer."""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm.bpe import id_type, special_pattern, special_tokens, split_words
from starloom.llm.support import bounded_batches
from starloom.operators.joins import dim_join
from starloom.session import materialize

# The most frequent pairs, at most so many, which tasks look up by themselves; all others are joined.
# Contexts and pieces with more than HOT_PAIRS distinct pairs are broadcast, at most HOT_NAMES of them, all others
# shuffled. All three only choose the way to the same result.
FREQUENT = 1 << 18
HOT_PAIRS = 1000
HOT_NAMES = 100_000
_CACHED_WORDS = 400_000
_HELD_PAIRS = 1 << 20


class _Pieces(dict):
    """Ids of each word met, as the bytes of their numbers; encoded once as long as memory allows."""

    def __init__(self, model: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.letter = {"<u2": "H", "<u4": "I"}[id_type(self.tokenizer)]

    def learn(self, texts: list[list[str]]) -> None:
        """Make sure that all words of ``texts`` are known."""
        met = set().union(*texts)
        if len(self) + len(met) > _CACHED_WORDS:
            self.clear()
        new = sorted(met.difference(self))
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            for word, found in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False)):
                self[word] = array(self.letter, found.ids).tobytes()


def _encode(batches: Iterator[pa.RecordBatch], model: str, special) -> Iterator[pa.RecordBatch]:
    pieces = _Pieces(model)
    for batch in batches:
        texts = [split_words(text.as_py() or "", special) for text in batch.column("text")]
        pieces.learn(texts)
        ids = [b"".join(map(pieces.__getitem__, words)) for words in texts]
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(ids, pa.binary())], ["key", "ids"])


def pairs_of(column: pa.Array, kind: str, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, pieces per text): each piece with the one before it, ``begin`` at the start, as one exact number."""
    parts = [np.frombuffer(x.as_py(), kind).astype(np.int64) for x in column]
    lengths = np.array([len(p) for p in parts], np.int64)
    word = np.concatenate([np.empty(0, np.int64), *parts])
    before = np.roll(word, 1)
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = begin
    return before << 32 | word, lengths


def _counted(code: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, every, target) of occurrences; one plain sort, with the mark of the target as lowest bit."""
    marked = np.sort(code << 1 | wanted)
    found = np.flatnonzero(np.diff(marked >> 1, prepend=-1))
    every = np.diff(np.append(found, len(marked)))
    return marked[found] >> 1, every, np.add.reduceat(marked & 1, found) if len(found) else every


def _merged(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, every, target) added up by code."""
    codes, *sums = (np.concatenate(x) for x in zip(*held))
    found, place = np.unique(codes, return_inverse=True)
    return found, *[np.bincount(place, weights=s, minlength=len(found)).astype(np.int64) for s in sums]


def _count_pairs(batches: Iterator[pa.RecordBatch], kind: str, begin: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def out() -> pa.RecordBatch:
        code, *sums = _merged(held)
        columns = [code >> 32, code & 0xFFFFFFFF, *sums]
        return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["before", "word", "every", "target"])

    for batch in batches:
        code, lengths = pairs_of(batch.column("ids"), kind, begin)
        wanted = np.repeat(batch.column("target").to_numpy(zero_copy_only=False).astype(np.int64), lengths)
        held.append(_counted(code, wanted))
        if sum(len(h[0]) for h in held) > _HELD_PAIRS:
            held = [_merged(held)]
            if len(held[0][0]) > _HELD_PAIRS // 2:
                yield out()
                held = []
    if held:
        yield out()


def pair_counts(ids: DataFrame, kind: str, begin: int) -> DataFrame:
    """``(before, word, every, target)`` over whole texts of ``(ids, target)``; tasks send sums, not occurrences."""
    count = partial(_count_pairs, kind=kind, begin=begin)
    sums = ids.mapInArrow(count, "before bigint, word bigint, every bigint, target bigint")
    return sums.groupBy("before", "word").agg(F.sum("every").alias("every"), F.sum("target").alias("target"))


def _looked_up(rows: DataFrame, table: DataFrame, on: str, pairs: str) -> DataFrame:
    """``rows`` joined to ``table``, which has every name: names in many pairs by broadcast, the others by shuffle."""
    values = [c for c in table.columns if c not in (on, pairs)]
    hot = table.where(F.col(pairs) > HOT_PAIRS).orderBy(F.desc(pairs), on).limit(HOT_NAMES)
    hot = materialize(hot.select(on, F.struct(*values).alias("hot")), "hot-names")
    # HOT_NAMES rows at most
    rows = rows.join(F.broadcast(hot), on, "left")
    # A row that has its values goes anywhere
    rows = rows.withColumn("at", F.when(F.col("hot").isNull(), F.col(on)).otherwise(F.xxhash64("before", "word")))
    cold = table.select(F.col(on).alias("at"), F.struct(*values).alias("cold"))
    joined = rows.join(cold.hint("shuffle_hash"), "at", "left").withColumn("found", F.coalesce("hot", "cold"))
    return joined.select("*", "found.*").drop("at", "hot", "cold", "found")


def pair_losses(counts: DataFrame) -> DataFrame:
    """``(before, word, every, target_loss, background_loss)``: bits that either model pays for the piece after ``before``.

    Both models are matched: same order, same vocabulary (all pieces of the corpus), same smoothing:
    Witten-Bell pairs backed by single pieces, and these by equal shares.
    """
    sides = ("every", "target")
    words = materialize(
        counts.groupBy("word").agg(*[F.sum(s).alias(f"word_{s}") for s in sides], F.count("*").alias("pairs")), "words"
    )
    contexts = materialize(
        counts.groupBy("before").agg(
            *[F.sum(s).alias(f"sum_{s}") for s in sides],
            *[F.count_if(F.col(s) > 0).alias(f"kinds_{s}") for s in sides],
            F.count("*").alias("pairs"),
        ),
        "contexts",
    )
    total = words.agg(F.count("*").alias("kinds"), *[F.coalesce(F.sum(f"word_{s}"), F.lit(0)).alias(s) for s in sides]).first()
    lower = words.select(
        "word", "pairs", *[((F.col(f"word_{s}") + 1) / F.lit(max(1, total[s] + total["kinds"]))).alias(f"low_{s}") for s in sides]
    )
    joined = _looked_up(_looked_up(counts, contexts, "before", "pairs"), lower, "word", "pairs")

    def loss(s: str):
        mixed = F.try_divide(F.col(s) + F.col(f"kinds_{s}") * F.col(f"low_{s}"), F.col(f"sum_{s}") + F.col(f"kinds_{s}"))
        return -F.log2(F.coalesce(mixed, F.col(f"low_{s}")))

    return joined.select("before", "word", "every", loss("target").alias("target_loss"), loss("every").alias("background_loss"))


def frequent_pairs(losses: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, target loss, background loss), sorted by code, of at most ``most`` pairs: all from some count on.

    The pairs are first counted by the power of two of their count, one row each, so no task sends more than it must.
    """
    power = F.floor(F.log2("every")).cast("int")
    sizes = {r.power: r.n for r in losses.groupBy(power.alias("power")).agg(F.count("*").alias("n")).collect()}
    least, taken = 63, 0
    for at in sorted(sizes, reverse=True):
        if taken + sizes[at] > most:
            break
        least, taken = at, taken + sizes[at]
    top = losses.where(F.col("every") >= 1 << least if least < 63 else F.lit(False)).toArrow()
    code = top["before"].to_numpy() << 32 | top["word"].to_numpy()
    order = np.argsort(code)
    return code[order], top["target_loss"].to_numpy()[order], top["background_loss"].to_numpy()[order]


def _sum_pairs(batches: Iterator[pa.RecordBatch], frequent: Broadcast, kind: str, begin: int) -> Iterator[pa.RecordBatch]:
    """Per text one row with its pieces and the losses of its frequent pairs, and one per other distinct pair."""
    codes, *losses = frequent.value
    for batch in batches:
        code, lengths = pairs_of(batch.column("ids"), kind, begin)
        doc = np.repeat(np.arange(len(lengths)), lengths)
        place = np.minimum(np.searchsorted(codes, code), max(len(codes) - 1, 0))
        known = codes[place] == code if len(codes) else np.zeros(len(code), bool)
        sums = [np.bincount(doc[known], weights=x[place[known]], minlength=len(lengths)).astype(float) for x in losses]
        rest = np.flatnonzero(~known)
        rest = rest[np.lexsort((code[rest], doc[rest]))]
        new = np.ones(len(rest), bool)
        new[1:] = (code[rest][1:] != code[rest][:-1]) | (doc[rest][1:] != doc[rest][:-1])
        times = np.diff(np.append(np.flatnonzero(new), len(rest)))
        rest = rest[new]
        row, some = batch.column("row"), len(rest)
        yield pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([row, row.take(pa.array(doc[rest]))]),
                pa.concat_arrays([batch.column("key"), pa.nulls(some, batch.column("key").type)]),
                pa.concat_arrays([pa.array(lengths), pa.nulls(some, pa.int64())]),
                *[pa.concat_arrays([pa.array(x), pa.nulls(some, pa.float64())]) for x in sums],
                pa.concat_arrays([pa.nulls(len(lengths), pa.int64()), pa.array(code[rest])]),
                pa.concat_arrays([pa.nulls(len(lengths), pa.int32()), pa.array(times.astype(np.int32))]),
            ],
            ["row", "key", "n_tokens", "target_sum", "background_sum", "code", "times"],
        )


def scored(
    docs: DataFrame,
    targets: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    frequent: int = FREQUENT,
) -> DataFrame:
    """One row per document: ``key``, ``n_tokens``, ``target_loss``, ``background_loss`` and ``score``.

    Both models count pairs of pieces over the vocabulary of all documents, the pieces of ``tokenizer`` (the path of a
    byte-level file) that occur there. The target model counts the documents
    whose key is in ``targets`` (one column ``key``, repeats and NULLs do no harm), the background model counts all.
    Losses are bits per piece, ``score`` is target minus background: the lower, the more a document is like the target. Whole texts
    are encoded once, counted and scored; counts and losses stay tables that grow with the corpus, and only the most
    frequent pairs, at most ``frequent``, reach the driver, to spare their join. Texts without pieces and NULL have NULL
    losses. Without target documents the target model gives equal shares. Repeated rows get the same answer each. An
    empty table gives no rows; other columns do not matter.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer, encoding="utf-8") as file:
        model = file.read()  # a vocabulary file of a few MB; tasks need no path to it
    known = Tokenizer.from_str(model)
    number, begin = id_type(known), 1 + max(known.get_vocab(with_added_tokens=True).values(), default=0)
    lean = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = lean.schema["key"].dataType.simpleString()
    encode = partial(_encode, model=model, special=special_pattern(special_tokens(tokenizer)))
    ids = materialize(lean.mapInArrow(encode, f"key {kind}, ids binary"), "lm-ids")
    wanted = targets.select(F.col("key").cast(kind)).where("key is not null").distinct()
    wanted = materialize(wanted, "targets").withColumn("target", F.lit(True))
    # pieces move where the targets are too many to broadcast, two bytes each; a hot key is sliced
    flagged = dim_join(ids, wanted, ["key"], "left").select("ids", F.coalesce("target", F.lit(False)).alias("target"))
    counts = materialize(pair_counts(flagged, number, begin), "pairs")
    losses = materialize(pair_losses(counts), "pair-losses")
    shared = spark.sparkContext.broadcast(frequent_pairs(losses, frequent))
    schema = f"row bigint, key {kind}, n_tokens bigint, target_sum double, background_sum double, code bigint, times int"
    score = partial(_sum_pairs, frequent=shared, kind=number, begin=begin)
    sent = ids.withColumn("row", F.monotonically_increasing_id()).mapInArrow(score, schema)
    # The row that stands for the text meets no pair: its place, below 0, is no code.
    sent = sent.withColumn("code", F.coalesce("code", -1 - F.col("row")))
    code = F.shiftleft("before", 32).bitwiseOR(F.col("word"))
    priced = losses.select(code.alias("code"), "target_loss", "background_loss")
    joined = sent.join(priced, "code", "left")
    sides = ("target", "background")
    own = [F.coalesce(f"{s}_sum", F.col("times") * F.col(f"{s}_loss")).alias(f"{s}_sum") for s in sides]
    whole = (
        joined.select("row", "key", "n_tokens", *own)
        .groupBy("row")
        .agg(F.max("key").alias("key"), F.max("n_tokens").alias("n_tokens"), *[F.sum(f"{s}_sum").alias(f"{s}_sum") for s in sides])
    )
    mean = [F.try_divide(F.col(f"{s}_sum"), F.col("n_tokens")).alias(f"{s}_loss") for s in sides]
    found = whole.select("key", "n_tokens", *mean)
    return found.withColumn("score", F.col("target_loss") - F.col("background_loss")).withColumnRenamed("key", key)
