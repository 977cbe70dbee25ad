"""Registered queries of the training-data operators: SQL twins and the pipeline, stage by stage."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import compare as twins  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402
import corpus_pipeline  # noqa: E402
from mercata.llm.catalog import LLM_ORACLES, LLM_QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_registered():
    names = entry_module.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in LLM_QUERIES} and "pipeline" in names
    assert set(LLM_ORACLES) <= set(entry_module.oracle_sql()) and 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_twin(spark, monkeypatch, name):
    monkeypatch.setattr(twins, "QUERIES", LLM_QUERIES)
    monkeypatch.setattr(twins, "ORACLES", LLM_ORACLES)
    state, note, _, _ = twins.compare(spark, twins.database(SF), SF, name)
    assert state == "ok", note


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        assert after.columns == columns
        gone = after.join(docs.select("doc_id", "text"), ["doc_id", "text"], "left_anti").count()
        assert gone == 0 and after.select("doc_id").distinct().count() <= seen[-1]
        if name == "exact_dedup":
            assert after.select("text").distinct().count() == after.count() == docs.select("text").distinct().count()
        docs, seen = after, [*seen, after.count()]
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_pipeline_on_empty_documents(spark, tmp_path):
    for table in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
