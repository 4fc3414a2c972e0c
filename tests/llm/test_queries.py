"""Registered queries with SQL against DuckDB, and the pipeline against its parts."""

import os

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from starloom.llm.queries import ORACLE, QUERIES
from tests.compare import connect, duck_rows, spark_rows

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not present")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, FOLDER)) == duck_rows(connect(FOLDER), ORACLE[name])


def test_pipeline_against_plain_python(spark):
    from tokenizers import Tokenizer

    from starloom.llm import mixing, quality
    from tests.llm.test_dedup import _components, _normal
    from tests.llm.test_text import TOKENIZER

    assert contract.queries()["pipeline"] is corpus_pipeline.run and len(QUERIES) == 13
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    rows = sorted(map(tuple, quality.selected(docs, model).collect()))
    first = {}
    for row in rows:
        first.setdefault(_normal(row[1]), row)
    rows = sorted(first.values())
    labels = _components([(r[0], r[1]) for r in rows])
    rows = [rows[i] for i in sorted(set(labels.values()))]
    copies = {r.doc_id: r.copies for r in mixing.mixed(spark.createDataFrame(rows, docs.schema)).collect()}
    tokenizer = Tokenizer.from_file(TOKENIZER)
    expected = []
    for row in rows:
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids
        expected += [(row[0], ids, tokenizer.decode(ids, skip_special_tokens=False))] * copies[row[0]]
    got = [(r.doc_id, list(r.ids), r.text) for r in corpus_pipeline.run(spark, FOLDER).collect()]
    assert sorted(got) == sorted(expected)
