"""The pipeline's stages one by one, and the registered queries against their SQL."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarrymill.llm import q_llm  # noqa: F401
from quarrymill.llm.registry import ORACLES, QUERIES
from quarrymill.plans.session import materialise
from tests.oracle import DATA, compare, connect

from . import helpers

FOLDER = f"{DATA}/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "n-gram Jaccard join", "best-fit packing"]
    before = docs
    accepted = materialise(corpus_pipeline.quality(spark, docs, FOLDER))
    assert accepted.columns == docs.columns and 0 < accepted.count() < docs.count()
    lines = materialise(corpus_pipeline.lines(spark, accepted, FOLDER))
    rows = [(r.doc_id, r.text) for r in accepted.collect()]
    expected = helpers.keep_lines(rows)
    assert {r.doc_id: r.text or "" for r in lines.collect()} == {i: t for i, (_, _, t) in expected.items()}
    assert lines.filter("n_chars <> char_length(text)").count() == 0
    unique = materialise(corpus_pipeline.near_copies(spark, lines, FOLDER))
    groups = helpers.near_copies([(r.doc_id, r.text) for r in lines.collect()])
    assert sorted(r.doc_id for r in unique.collect()) == sorted(i for i, _, c in groups if i == c)
    packed = corpus_pipeline.packing(spark, unique, FOLDER)
    total = sum(len(helpers.words(r.text)) + 1 for r in unique.collect())
    assert packed.agg(F.sum("n_tokens")).first()[0] == total
    assert before.columns == unique.columns


def test_stages_on_odd_rows(spark):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    rows = [(None, "a b c", "en", None, None), (1, None, None, "s", 0), (1, None, None, "s", 0), (2, "", "en", "s", 0)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, FOLDER))
        assert docs.columns[0] == "doc_id"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    message, n = compare(spark, connect(FOLDER), FOLDER, QUERIES[name], ORACLES.get(name))
    assert message is None and n > 0
