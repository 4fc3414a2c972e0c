"""BPE encoding and decoding through tables of distinct words and pieces.

Texts are cut into words, and words coded by their place in the dictionary of a block
of some thousand documents. Only dictionaries are shuffled: to the words, where each distinct word of the corpus is
encoded once, and back to the blocks with the ids. The coded texts lie in a bucketed table and do not move.
"""

from __future__ import annotations

import json
import os
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm.support import bounded_batches
from starloom.session import scratch_path

# A block closes when its texts reach this size; that bounds its dictionary, too.
BLOCK_CHARS = 32 << 20
ENCODE_AT_ONCE = 2000
TOKENS_AT_ONCE = 1 << 18

# Fixed pattern of byte-level tokenizers: what it separates is encoded independently.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def special_tokens(path: str) -> list[str]:
    """Added tokens of a tokenizer file: they are cut out of a text before anything else."""
    with open(path, encoding="utf-8") as file:
        return [token["content"] for token in json.load(file).get("added_tokens", [])]


def split_words(text: str, special: regex.Pattern | None) -> list[str]:
    """Parts of a text that the tokenizer encodes independently of each other; joined, they are the text."""
    if special is None or not special.search(text):
        return WORDS.findall(text)
    parts = special.split(text)  # every other part is a special token
    return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else WORDS.findall(part))]


def special_pattern(tokens: list[str]) -> regex.Pattern | None:
    longest_first = sorted(tokens, key=len, reverse=True)
    return regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if tokens else None


def _packed(codes: np.ndarray) -> bytes:
    """Codes as compressed bytes, byte by byte; frequent words have small codes, so the high bytes hardly cost."""
    return zstandard.compress(np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T), 3)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _to_blocks(batches: Iterator[pa.RecordBatch], special: regex.Pattern | None, kind: pa.DataType):
    known: dict[str, int] = defaultdict()
    known.default_factory = known.__len__
    keys, lengths, codes, chars = [], [], [], 0

    def block() -> pa.RecordBatch:
        flat = np.concatenate([np.zeros(0, np.int32), *codes])
        order = np.argsort(-np.bincount(flat, minlength=len(known)), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        words = pa.array(list(known), pa.string())
        sorted_words = pc.sort_indices(words)  # in order, words take half the space wherever they are written
        whole = pa.array([0, len(order)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([uuid.uuid4().int >> 65]),
                pa.ListArray.from_arrays(pa.array([0, len(lengths)], pa.int32()), pa.concat_arrays(keys)),
                pa.array([lengths], pa.list_(pa.int32())),
                pa.array([_packed(rank[flat])], pa.binary()),
                pa.ListArray.from_arrays(whole, words.take(sorted_words)),
                pa.ListArray.from_arrays(whole, pa.array(rank).take(sorted_words)),
            ],
            ["block", "keys", "lengths", "codes", "words", "places"],
        )

    for batch in batches:
        key = batch.column("key")
        for i, text in enumerate(batch.column("text").to_pylist()):
            words = split_words(text or "", special)
            keys.append(key.slice(i, 1))
            lengths.append(len(words))
            codes.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
            chars += len(text or "")
            if chars >= BLOCK_CHARS:
                yield block()
                known.clear()
                pa.default_memory_pool().release_unused()
                keys, lengths, codes, chars = [], [], [], 0
    if keys:
        yield block()
    known.clear()
    pa.default_memory_pool().release_unused()


def bucketed(df: DataFrame, column: str) -> DataFrame:
    """``df`` written to the shared folder in buckets of ``column``: joins by it need no shuffle of this side.

    The table is known to the catalog only while it is written; the files stay.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.bucketBy(buckets, column).option("path", scratch_path(spark, "bucketed"))
    writer.option("compression", "zstd").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files are not touched
    return table


def word_blocks(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Table of ``(block, keys, lengths, codes, words, places)``: documents as places in the dictionary of their block.

    Written to the shared folder: a block's name and dictionary are settled once and do not change
    when a task is repeated.
    """
    bounded_batches(docs.sparkSession)
    lean = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = (
        f"block bigint, keys array<{lean.schema['key'].dataType.simpleString()}>, "
        "lengths array<int>, codes binary, words array<string>, places array<int>"
    )
    special = special_pattern(special_tokens(tokenizer))
    return bucketed(lean.mapInArrow(partial(_to_blocks, special=special, kind=_arrow_type(lean, "key")), schema), "block")


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    return df.limit(0).select(column).toArrow().schema.field(0).type


def id_type(tokenizer: Tokenizer) -> str:
    """The narrowest unsigned number that holds every id."""
    return "<u2" if max(tokenizer.get_vocab(with_added_tokens=True).values(), default=0) < 1 << 16 else "<u4"


def _ids_as_bytes(ids: pa.ListArray, kind: str) -> pa.Array:
    """Each list of ids as the bytes of its numbers."""
    data = ids.flatten().to_numpy().astype(kind)
    ends = (ids.offsets.to_numpy() * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _encode(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by word: equal words are encoded once, at the end of one batch and the start of the next, too."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads would each keep memory
    tokenizer = Tokenizer.from_str(model)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    kind = id_type(tokenizer)
    last, last_ids = None, []
    for batch in batches:
        coded = batch.column("word").dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = distinct and distinct[0] == last
        found = [last_ids] if known else []
        for at in range(len(found), len(distinct), ENCODE_AT_ONCE):
            part = distinct[at : at + ENCODE_AT_ONCE]
            found += [e.ids for e in tokenizer.encode_batch(part, add_special_tokens=False)]
        if found:
            last, last_ids = distinct[-1], found[-1]
        ids = _ids_as_bytes(pa.array(found, pa.list_(pa.int32())), kind)
        yield pa.RecordBatch.from_arrays(
            [batch.column("block"), batch.column("pos"), ids.take(coded.indices)], ["block", "pos", "ids"]
        )
    pa.default_memory_pool().release_unused()


def encoded_words(blocks: DataFrame, tokenizer: str) -> DataFrame:
    """``(block, pos, ids)``: the ids of each word of each block's dictionary, as bytes.

    The dictionaries meet by word, sorted, and each distinct word is encoded once. A frequent
    word has one row per block, not one per text.
    """
    with open(tokenizer, encoding="utf-8") as file:
        model = file.read()  # a vocabulary file of a few MB; tasks need no path to it
    words = blocks.select("block", F.posexplode("words").alias("pos", "word"))
    met = words.repartition("word").sortWithinPartitions("word")
    return met.mapInArrow(partial(_encode, model=model), "block bigint, pos int, ids binary")


def _bytes_of_letters() -> dict[str, int]:
    """Byte-level vocabularies spell each byte as one letter: printable Latin ones as themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def piece_table(tokenizer: str) -> tuple[np.ndarray, np.ndarray, str]:
    """The pieces of a byte-level tokenizer file by id: all bytes in a row, where each starts and ends, the type of ids."""
    letters = _bytes_of_letters()
    with open(tokenizer, encoding="utf-8") as file:
        model = Tokenizer.from_str(file.read())
    vocabulary = model.get_vocab(with_added_tokens=True)
    pieces = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for piece, number in vocabulary.items():
        spelled = all(letter in letters for letter in piece)
        pieces[number] = bytes(letters[x] for x in piece) if spelled else piece.encode()
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
    return np.frombuffer(b"".join(pieces), np.uint8), bounds, id_type(model)


def _gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of the runs ``starts[i] .. starts[i] + sizes[i]``, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def _assemble(block: pa.Table, words: pa.Table, pieces: tuple[np.ndarray, np.ndarray, str], kind: pa.DataType) -> pa.Table:
    """Documents of one block: ids joined back by position, text joined from the pieces of the ids."""
    if not block.num_rows:
        raise ValueError("words without a block")
    at_place = words["pos"].to_numpy()
    spelled = words["ids"].combine_chunks().cast(pa.large_binary())
    data, bounds, number = pieces
    flat = np.frombuffer(b"".join(spelled.to_pylist()), number).astype(np.int32)
    sizes = pc.binary_length(spelled).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(number).itemsize
    starts = np.cumsum(sizes) - sizes
    batches = []
    for row in block.to_batches():
        order = np.argsort(row.column("places")[0].values.to_numpy()[at_place])
        starts, sizes = starts[order], sizes[order]
        codes = _unpacked(row.column("codes")[0].as_py())
        lengths = row.column("lengths")[0].values.to_numpy()
        keys, at, first, held, parts = row.column("keys")[0].values, 0, 0, 0, []
        for i, length in enumerate(lengths):
            part = codes[at : at + length]
            at += length
            parts.append(flat[_gathered(starts[part], sizes[part])])
            held += len(parts[-1])
            if held >= TOKENS_AT_ONCE or i == len(lengths) - 1:
                ids = np.concatenate(parts)
                bytes_of = bounds[ids + 1] - bounds[ids]
                text = data[_gathered(bounds[ids], bytes_of)].tobytes()
                ends = np.cumsum([len(p) for p in parts])
                cut = np.concatenate([[0], np.cumsum(bytes_of)])[np.concatenate([[0], ends])]
                texts = [text[a:b].decode("utf-8", "replace") for a, b in zip(cut, cut[1:])]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids))
                columns = [keys.slice(first, len(parts)).cast(kind), lists, pa.array(texts, pa.string())]
                batches.append(pa.RecordBatch.from_arrays(columns, ["key", "ids", "text"]))
                first, held, parts = i + 1, 0, []
    return pa.Table.from_batches(batches)


def round_trip(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, its token ``ids`` and the ``text`` decoded from them.

    ``tokenizer`` is the path of a byte-level tokenizer file, read on the driver. Whole texts are
    encoded, special tokens that occur in a text as such; decoding keeps them and replaces what is no UTF-8. The
    id-to-piece join happens inside the tasks, each of which holds the pieces: one per id of
    the vocabulary file, which bounds the table. NULL and empty
    texts have no ids and decode to empty text. Repeated rows and NULL keys stay as they are, because rows are not
    joined by key. An empty table gives no rows; other columns do not matter.
    """
    blocks = word_blocks(docs, tokenizer, key, text)
    pieces, kind = piece_table(tokenizer), _arrow_type(docs, key)

    def assemble(block, words):
        return _assemble(block, words, pieces, kind)

    coded = blocks.select("block", "keys", "lengths", "codes", "places").groupBy("block")
    found = coded.cogroup(encoded_words(blocks, tokenizer).groupBy("block"))
    schema = f"key {docs.schema[key].dataType.simpleString()}, ids array<int>, text string"
    return found.applyInArrow(assemble, schema).withColumnRenamed("key", key)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number of tokens, digest of the ids joined by commas, and digest of the decoded text."""
    return found.select(
        key,
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
