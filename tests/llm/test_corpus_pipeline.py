import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from depotlens.llm import minhash, packing, quality, queries, toxicity

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
        ids = {r[0] for r in out.select("doc_id").collect()}
        if name == "toxicity":
            want = toxicity.score(docs, toxicity.fit(docs, labels)).where("predicted = 0")
        elif name == "quality":
            want = quality.judge(docs, labels).where("kept")
        elif name == "near_dedup":
            want = minhash.link(docs).where("kept")
        else:
            want = docs
            assert out.where(F.col("text").contains("AKIA")).count() == 0
            assert out.where(F.col("n_chars") != F.length("text")).count() == 0
        assert ids == {r[0] for r in want.select("doc_id").collect()}, name
        docs = out
    rows = cp.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == ids
    assert len({r["sequence_id"] for r in rows}) <= sum(r["length"] for r in rows) / packing.CAPACITY * 1.05 + 1


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_first_queries_of_each_number():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
