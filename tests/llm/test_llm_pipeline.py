"""The pipeline's stages, one after another, against what each one's operator decides alone."""

import os

import pytest
from llm_cases import clashing, documents

import corpus_pipeline
from rainpanel.llm import near_copies, quality, toxicity
from rainpanel.llm.common import table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def test_stages(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "toxicity":
            want = {r.doc_id for r in toxicity.toxicity_query(before, table(spark, FOLDER, "labels")).filter("predicted = 0").collect()}
        elif name == "quality rules":
            want = {r.doc_id for r in quality.quality_query(before).filter("kept").collect()}
        elif name == "SimHash near-dedup":
            want = {r.doc_id for r in near_copies.near_groups(before).filter("doc_id = component_id").collect()}
        else:
            want = {r.doc_id for r in before.select("doc_id").collect()}
        assert ids == want, name


def test_odd_rows_pass_through(spark):
    docs = clashing(documents(spark))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
    assert docs.columns == clashing(documents(spark)).columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).columns[0] == "doc_id"
