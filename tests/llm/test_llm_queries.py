"""The registered queries of the subpackage, over the smallest given tables."""

import os

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from tidemark.llm.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def test_all_operators_and_the_pipeline_are_registered():
    names = set(contract.queries())
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op")} and "pipeline" in names
    assert set(QUERIES) <= names and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, name):
    assert compare.differences(spark, compare.connect(FOLDER), name, QUERIES[name], ORACLES[name], FOLDER) == []


@pytest.mark.parametrize("name", ["op4_language_id", "op5_quality_neighbours", "op8_toxicity", "op9_quality_rules"])
def test_one_row_per_document(spark, name):
    rows = QUERIES[name](spark, FOLDER)
    ids = [r["doc_id"] for r in rows.select("doc_id").collect()]
    assert sorted(ids) == sorted(r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect())
    if "score" in rows.columns:
        assert rows.where(~F.col("score").between(0, 1)).isEmpty()


def test_stages_pass_documents_on(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    copies = docs.unionByName(docs.limit(20).withColumn("doc_id", F.col("doc_id") + 10_000_000))
    kept = dict(corpus_pipeline.STAGES)["exact dedup"](spark, copies, FOLDER)
    assert kept.columns == docs.columns
    assert kept.where("doc_id >= 10000000").isEmpty()
    near = dict(corpus_pipeline.STAGES)["n-gram jaccard join"](spark, kept, FOLDER)
    mixed = dict(corpus_pipeline.STAGES)["mixing sources"](spark, near, FOLDER)
    assert mixed.columns == docs.columns and 0 < mixed.count() <= near.count() <= kept.count()
    packed = dict(corpus_pipeline.STAGES)["packing"](spark, mixed, FOLDER)
    assert packed.select("doc_id").distinct().count() == mixed.count()
