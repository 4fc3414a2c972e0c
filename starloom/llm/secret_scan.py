"""Secret scans: fixed patterns, and strings in sensitive context that zstandard cannot make smaller."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import partial
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.support import bounded_batches

# Fixed patterns, with the least length of the part that counts.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is taken whole, so this finds the long runs of [0-9a-f]+
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "novel")

# Words after which a string may be a secret, and how far from the word, or from the end of the identifier that the
# word is part of, it may begin.
SENSITIVE = (
    "password", "passwd", "passphrase", "secret", "token", "apikey", "api_key", "api-key", "credential",
    "authorization", "bearer", "private_key", "private-key", "signature",
)
CONTEXT = re.compile("|".join(map(re.escape, SENSITIVE)), re.ASCII | re.IGNORECASE)
REACH = 40
IDENTIFIER_REST = re.compile(r"[A-Za-z0-9_.-]*")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]+(?:\.[A-Za-z0-9+/_=-]+)*")  # segments joined by dots are one string
LEAST = 16
# A string that is plain as a whole is cut at these, one after the other, and its parts are measured.
CUTS = tuple(map(re.compile, (r"[^.]+", r"[^=]+", r"[^+/_-]+")))

# Characters on either side of a candidate that it is measured against.
SURROUNDING = 512
# A candidate is reported if each of its bytes costs at least this many compressed bytes: letters and digits
# at random cost three quarters of a byte each.
NOVELTY = 0.65
# Identifiers that prime the compressor, the most frequent of all documents. Shorter than a candidate and without
# digits, so that a secret that is copied often does not become one.
IDENTIFIERS = 2000
_IDENTIFIER = r"^[A-Za-z_]{4,15}$"
_FLUSH_WORDS = 200_000

SPANS = "array<struct<kind:string,start:int,end:int,marginal:int>>"
_SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.int32())])
)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of the fixed patterns, in code points; each kind from left to right without overlap."""
    found = []
    low = text.lower()
    if any(word in low for word in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans of all long strings that begin near a sensitive word or near the identifier it is part of.

    Where the word is part of a string itself, the rest behind the word is a candidate.
    """
    low = text.lower()
    if not any(word in low for word in SENSITIVE):
        return []
    strings = [m.span() for m in CANDIDATE.finditer(text)]
    starts = [start for start, _ in strings]
    found, done = set(), 0
    for hit in CONTEXT.finditer(text):
        at = hit.end()
        place = bisect_right(starts, at) - 1
        if place >= 0 and strings[place][0] < at < strings[place][1]:
            found.add((at, strings[place][1]))
        last = IDENTIFIER_REST.match(text, at).end() + REACH
        done = max(done, bisect_left(starts, at))
        while done < len(strings) and starts[done] <= last:
            found.add(strings[done])
            done += 1
    return sorted((start, end) for start, end in found if end - start >= LEAST)


def _without_copies(around: str, string: str) -> str:
    """``around`` without other copies of ``string``, whole ones or such that its ends cut through."""
    around = around.replace(string, "")
    for n in range(min(len(string) - 1, len(around)), LEAST // 2, -1):
        if around.startswith(string[-n:]):
            around = around[n:]
            break
    for n in range(min(len(string) - 1, len(around)), LEAST // 2, -1):
        if around.endswith(string[:n]):
            return around[:-n]
    return around


def marginal_bytes(text: str, start: int, end: int, compressor: zstandard.ZstdCompressor) -> int:
    """Compressed bytes that the span adds to the text around it, less the span's own copies there."""
    string = text[start:end]
    sides = (text[end : end + SURROUNDING], text[max(0, start - SURROUNDING) : start])
    around = b"".join(_without_copies(side, string).encode() for side in sides)
    return len(compressor.compress(around + string.encode())) - len(compressor.compress(around))


def secret_spans(text: str | None, compressor: zstandard.ZstdCompressor, novelty: float = NOVELTY) -> list[tuple]:
    """All spans of a text as (kind, start, end, marginal), by start, then kind; ``marginal`` only for novel ones.

    A candidate inside a base span adds nothing. NULL and empty text have none.
    """
    if not text:
        return []
    base = base_spans(text)
    spans = [(*span, None) for span in base]
    starts = sorted(start for _, start, _ in base)
    ends = list(accumulate((end for _, _, end in sorted(base, key=lambda span: span[1])), max))

    def novel(start: int, end: int, cuts: tuple) -> Iterator[tuple]:
        before = bisect_right(starts, start)
        if end - start < LEAST or (before and end <= ends[before - 1]):  # short, or inside a base span
            return
        marginal = marginal_bytes(text, start, end, compressor)
        if marginal >= novelty * (end - start):
            yield ("novel", start, end, marginal)
            return
        for level, cut in enumerate(cuts):
            parts = [m.span() for m in cut.finditer(text, start, end)]
            if parts != [(start, end)]:
                for part in parts:
                    yield from novel(*part, cuts[level + 1 :])
                return

    found = {span for candidate in candidates(text) for span in novel(*candidate, CUTS)}
    reached = 0
    for span in sorted(found, key=lambda span: (span[1], -span[2])):
        if span[2] > reached:  # not inside a longer one
            spans.append(span)
            reached = span[2]
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0])))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, count) of the identifiers in the batches, summed up as far as memory allows."""
    held, words = [], 0

    def summed() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).group_by("word").aggregate([("n", "sum")])
        return table.rename_columns(["word", "n"]).combine_chunks().to_batches()[0]

    for batch in batches:
        text = batch.column(0).cast(pa.large_string())
        parts = pc.list_flatten(pc.ascii_split_whitespace(text.drop_null()))
        counted = pc.value_counts(parts)
        word = counted.field("values")
        keep = pc.match_substring_regex(word, _IDENTIFIER)
        one = pa.RecordBatch.from_arrays(
            [word.filter(keep).cast(pa.string()), counted.field("counts").filter(keep)], ["word", "n"]
        )
        if one.num_rows:
            held.append(one)
            words += one.num_rows
        if words > _FLUSH_WORDS:
            one = summed()
            if one.num_rows > _FLUSH_WORDS // 2:
                yield one
                held, words = [], 0
            else:
                held, words = [one], one.num_rows
    if held:
        yield summed()


def identifier_dictionary(docs: DataFrame, text: str = "text", identifiers: int = IDENTIFIERS) -> bytes:
    """The most frequent identifiers of all documents, as a dictionary of at most ``16 * identifiers`` bytes.

    The words are counted in Spark; only the ``identifiers`` top ones reach the
    driver. The most frequent stand last, where references to them cost least.
    """
    bounded_batches(docs.sparkSession)
    counts = docs.select(F.col(text).alias("text")).mapInArrow(_word_counts, "word string, n bigint")
    top = counts.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(identifiers).collect()
    return " ".join(row["word"] for row in reversed(top)).encode()


def _scan(batches: Iterator[pa.RecordBatch], dictionary: bytes, novelty: float) -> Iterator[pa.RecordBatch]:
    primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    compressor = zstandard.ZstdCompressor(level=3, dict_data=primed if len(dictionary) >= 8 else None)
    for batch in batches:
        spans = [
            [dict(zip(("kind", "start", "end", "marginal"), s)) for s in secret_spans(t.as_py(), compressor, novelty)]
            for t in batch.column("text")
        ]
        rest = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*batch.select(rest).columns, pa.array(spans, _SPAN_TYPE)], [*rest, "spans"]
        )


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text", novelty: float = NOVELTY) -> DataFrame:
    """``key`` and ``spans`` of every document: the fixed patterns and the novel strings.

    Dictionary-primed novelty: the compressor knows the most frequent identifiers of the
    whole corpus and the text around a candidate; what the candidate then still
    adds to the compressed size is its marginal cost. A string near a sensitive
    word that costs nearly its own length is reported as ``novel``. Whole texts are
    read. NULL and empty texts have no spans; repeated rows and NULL keys stay as they
    are; an empty table gives no rows. Other columns do not matter.
    """
    dictionary = identifier_dictionary(docs, text)
    bounded_batches(docs.sparkSession)
    lean = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = lean.schema["key"].dataType.simpleString()
    found = lean.mapInArrow(partial(_scan, dictionary=dictionary, novelty=novelty), f"key {kind}, spans {SPANS}")
    return found.withColumnRenamed("key", key)


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts per kind, the digest of the base spans, and all spans as text."""
    spans = F.col("spans")
    return found.select(
        key,
        *[count_kind(spans, kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined_spans(F.filter(spans, lambda s: s["kind"] != "novel")), 256).alias("base_sha256"),
        joined_spans(spans).alias("spans"),
    )
