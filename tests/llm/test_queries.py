"""The registered queries against their SQL, and the pipeline, on the smallest tables."""

from __future__ import annotations

import pytest
from check_oracles import connect, difference

import corpus_pipeline
from tradelake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    assert difference(QUERIES[name](spark, SF), duck, ORACLES[name]) is None


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        after = docs.count()
        assert 0 < after and (after <= before or name == "mixing sources")
        before = after


def test_pipeline_clashing_columns_and_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = docs.selectExpr("*", "1 as score", "'x' as node", "2 as size", "3 as kept", "4 as __text", "5 as copies")
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF)
        assert {"score", "node", "size", "kept", "__text", "copies"} <= set(docs.columns)
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name


def test_pipeline_drops_copies(spark):
    text = " ".join(f"word{k}" for k in range(200))
    rows = [(5, text, "en", "a", 1), (3, text, "en", "a", 1), (9, text.replace("word7 ", "other "), "en", "b", 1), (4, "something else " * 3, "en", "b", 1), (None, text, "en", "b", 1), (4, "something else " * 3, "en", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 3), (False, 4), (True, None)]
