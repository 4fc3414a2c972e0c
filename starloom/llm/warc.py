"""WARC archives: written as text files, read back as a stream, revisits resolved by payload digest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.support import bounded_batches
from starloom.session import materialize

# Payloads below this are stored again rather than referred to.
REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
END = "\r\n"
GAP = b"\r\n\r\n"  # after a header, and after each record
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

READ = (
    "record_id string, record_type string, page_id bigint, uri string, refers_to string, "
    "payload_bytes bigint, payload_digest string"
)


def originals(pages: DataFrame, key: str, payload: str, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``(payload_digest, original)`` of payloads that several records share and that are long enough.

    Only headers are shuffled: digest, length and key, combined before the
    shuffle, so the copies of one payload never meet in one task.
    """
    headers = pages.select(
        F.col(key).alias("key"), F.sha1(payload).alias("payload_digest"), F.octet_length(payload).alias("bytes")
    )
    groups = headers.where(F.col("bytes") >= least_bytes).groupBy("payload_digest")
    return groups.agg(F.max("key").alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")


def record_id(key: Column, digest: Column) -> Column:
    """A uuid that follows from the key and the payload."""
    md5 = F.md5(F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("-")), digest))
    parts = [F.substring(md5, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def records(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = REVISIT_BYTES
) -> DataFrame:
    """One column ``value``: the WARC record of each page, with fresh headers, without its closing gap.

    Of records with equal payloads of at least ``least_bytes``, those with the
    largest key are responses, the others revisits of it that hold only
    HTTP headers. A NULL payload is empty. A page without a key gets
    no key header and is a revisit if its payload is stored under some key. White space and control characters
    in a url become ``%20``, so that a url cannot end its header line.
    """
    lean = pages.select(
        F.col(key).cast("bigint").alias("key"),
        F.regexp_replace(F.col(url), r"[\x00-\x20\x7F]+", "%20").alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("payload"),
    )
    firsts = materialize(originals(lean, "key", "payload", least_bytes), "originals")
    marked = lean.withColumn("payload_digest", F.sha1("payload")).join(firsts, "payload_digest", "left")
    # NULL-safe, because a group without any key has only responses
    revisit = (F.octet_length("payload") >= least_bytes) & F.col("original").isNotNull()
    marked = marked.withColumn("revisit", revisit & ~F.col("original").eqNullSafe(F.col("key")))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.octet_length("payload"),
        F.lit(END + END),
    )
    block = F.concat(http, F.when(F.col("revisit"), F.lit("")).otherwise(F.col("payload")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(END))
    header = F.concat_ws(
        "",
        F.lit(f"WARC/1.1{END}"),
        line("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", record_id(F.col("key"), F.col("payload_digest"))),
        F.lit(f"WARC-Date: {DATE}{END}"),
        line("WARC-Page-ID", F.col("key").cast("string")),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(F.col("revisit"), line("WARC-Refers-To", record_id(F.col("original"), F.col("payload_digest")))),
        F.when(F.col("revisit"), F.lit(f"WARC-Profile: {PROFILE}{END}")),
        F.lit(f"Content-Type: application/http;msgtype=response{END}"),
    )
    sized = marked.select(header.alias("header"), block.alias("block"))
    return sized.select(
        F.concat("header", line("Content-Length", F.octet_length("block").cast("string")), F.lit(END), "block").alias(
            "value"
        )
    )


def write_archives(lines: DataFrame, path: str) -> None:
    """Write records to gzip archives below ``path``; the gap that closes a record is the line end."""
    lines.write.option("compression", "gzip").option("lineSep", GAP.decode()).text(path)


def parsed(chunks: Iterator[bytes]) -> Iterator[tuple[dict, bytes]]:
    """Headers (names in lower case) and block of each record in a stream of archives.

    Records are cut by their stated length, so a payload may hold gaps, line
    ends or whole archives. Line ends before a record are skipped: an archive whose last payload ends in one is
    cut by the text source before that line end, which then gets a gap of its own. At most one chunk and one
    record are in memory.
    """
    rest = b""
    for chunk in chunks:
        data, at = rest + chunk, 0
        while True:
            while data.startswith(b"\r\n", at):
                at += 2
            if (head := data.find(GAP, at)) < 0:
                break
            lines = data[at:head].decode("utf-8", "replace").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"no record at <{lines[0][:40]}>")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            begin = head + len(GAP)
            end = begin + int(fields["content-length"])
            if len(data) < end + len(GAP):
                break
            yield fields, data[begin:end]
            at = end + len(GAP)
        rest = data[at:]
    if rest:
        raise ValueError(f"{len(rest)} bytes of an unfinished record")


def _rows(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in READ.split(", ")] + ["payload"] * with_payload

    def chunks() -> Iterator[bytes]:
        for batch in batches:
            pieces = batch.column(0).cast(pa.large_binary()).to_pylist()
            yield b"".join(x for piece in pieces for x in (piece, GAP))

    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    rows, held = [], 0
    for fields, block in parsed(chunks()):
        payload = block.partition(GAP)[2]
        page = fields.get("warc-page-id")
        revisit = fields["warc-type"] == "revisit"
        row = (
            fields["warc-record-id"],
            fields["warc-type"],
            None if page is None else int(page),
            fields.get("warc-target-uri"),
            fields.get("warc-refers-to"),
            None if revisit else len(payload),
            None if revisit else hashlib.sha1(payload).hexdigest(),
        )
        rows.append((*row, payload) if with_payload else row)
        held += len(payload) if with_payload else 100
        if held > 8 << 20:
            yield table(rows)
            rows, held = [], 0
    if rows:
        yield table(rows)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records below ``path``; length and digest are taken from the stored payload, NULL for revisits.

    Gzip files are not split, so the lines of one archive reach one task in
    order; Spark streams them, and the parser joins them again.
    """
    bounded_batches(spark)
    lines = spark.read.option("lineSep", GAP.decode()).schema("value string").text(path)
    schema = READ + (", payload binary" if with_payload else "")
    return lines.mapInArrow(partial(_rows, with_payload=with_payload), schema)


def resolved(read: DataFrame) -> DataFrame:
    """One row per record, revisits with the length, digest and page of the response they refer to.

    A revisit whose response is missing keeps NULL there. Responses that
    repeat a record id (repeated rows) count once.
    """
    responses = read.where("record_type = 'response'")
    firsts = materialize(
        responses.groupBy(F.col("record_id").alias("refers_to")).agg(
            F.max("page_id").alias("original"),
            F.max("payload_bytes").alias("full_bytes"),
            F.max("payload_digest").alias("full_digest"),
        ),
        "responses",
    )
    revisits = read.where("record_type = 'revisit'").join(firsts, "refers_to", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    plain = responses.withColumn("refers_to", F.lit(None).cast("bigint")).select(*columns)
    return plain.unionByName(
        revisits.select(
            "page_id",
            F.col("full_bytes").alias("payload_bytes"),
            F.col("full_digest").alias("payload_digest"),
            "record_type",
            F.col("original").alias("refers_to"),
        )
    )


def archived(pages: DataFrame, path: str, **columns) -> DataFrame:
    """Write ``pages`` to deduplicated archives below ``path``, read them back, and resolve the revisits.

    Returns one row per page: ``page_id``, ``payload_bytes``, ``payload_digest``,
    ``record_type`` and ``refers_to``. Rows that repeat the largest key of a payload are all responses;
    payloads of which no record has a key are responses, too. An empty table gives no rows.
    """
    write_archives(records(pages, **columns), path)
    return resolved(materialize(read_archives(pages.sparkSession, path), "records"))


SQL = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), marked AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM payloads
), typed AS (
    SELECT *, payload_bytes >= 1000 AND original IS NOT NULL AND page_id IS DISTINCT FROM original AS revisit
    FROM marked
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN original END AS refers_to
FROM typed
"""
