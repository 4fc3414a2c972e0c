"""The queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starloom.llm import (
    bpe,
    embedding_dedup,
    exact_dedup,
    lexical_search,
    lm_score,
    mixing,
    pii,
    quality,
    secret_scan,
    simhash,
    url_filter,
    warc,
    whitening,
)
from starloom.llm.registry import ORACLE, QUERIES, query
from starloom.queries.registry import table
from starloom.session import scratch_path

__all__ = ["ORACLE", "QUERIES"]

TOKENIZER = "byte_bpe_50k.json"


@query(warc.SQL)
def op1_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written to archives and read back."""
    return warc.archived(table(spark, folder, "pages"), scratch_path(spark, "warc"))


@query()
def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade, tail probability and selection of all documents, after a fit on a sample of the labels."""
    docs = table(spark, folder, "documents")
    return quality.graded(docs, quality.fit(docs, table(spark, folder, "labels")), ["doc_id"])


@query()
def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in all documents."""
    return secret_scan.digest(secret_scan.scanned(table(spark, folder, "documents")))


@query()
def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded and decoded."""
    tokenizer = public_tokenizers.path(TOKENIZER)
    return bpe.digest(bpe.round_trip(table(spark, folder, "documents"), tokenizer))


@query(mixing.SQL)
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to the target weights of their sources."""
    mixed = mixing.mixed(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query(url_filter.SQL)
def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on all pages."""
    return url_filter.judged(table(spark, folder, "pages"))


@query(
    r"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
), named AS (SELECT doc_id, sha256(body) AS text_sha256 FROM texts)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM named WINDOW same AS (PARTITION BY text_sha256)
"""
)
def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal texts over all documents."""
    groups = exact_dedup.exact_groups(table(spark, folder, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query()
def op8_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.95."""
    return embedding_dedup.near_vectors(table(spark, folder, "embeddings"))


@query()
def op9_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """All documents under a model of the well rated ones and one of the whole corpus, over pieces of the tokenizer."""
    good = table(spark, folder, "labels").where("quality = 1 and toxic = 0").selectExpr("doc_id AS key")
    return lm_score.scored(table(spark, folder, "documents"), good, public_tokenizers.path(TOKENIZER))


@query()
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and their components at 2 bits."""
    groups = simhash.near_groups(table(spark, folder, "documents"))
    return groups.select("doc_id", "fingerprint", "component_id")


@query()
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """All vectors along the first 16 eigenvectors of the covariance of the distinct ones."""
    vectors = table(spark, folder, "embeddings")
    found = whitening.whitened(vectors, whitening.fit(vectors, "embedding"), "vec_id", "embedding")
    return found.withColumnRenamed("id", "vec_id")


@query(lexical_search.SQL)
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    found = lexical_search.ranked(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), "doc_id", "text", "item_id", "text"
    )
    return found.select(found.item.alias("item_id"), "rank", found.doc.alias("doc_id"), "score")


@query()
def op13_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in all documents."""
    return pii.digest(pii.scanned(table(spark, folder, "documents"), "text", keep=["doc_id"]), ["doc_id"])
