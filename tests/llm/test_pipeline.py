from __future__ import annotations

import corpus_pipeline
from lintlake.llm import queries

DATA = "/root/testdata/sf0.001"


def test_stages_keep_clean_documents_and_drop_the_rest(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    good = {r["doc_id"] for r in spark.read.parquet(f"{DATA}/labels.parquet").filter("quality = 1").collect()}
    before = {r["doc_id"] for r in docs.select("doc_id").collect()}
    kept = {}
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, DATA).cache()
        assert docs.columns == corpus_pipeline.COLUMNS
        kept[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert kept[name] <= before
        before = kept[name]
    assert len(good & kept["language ID"]) == len(good)
    assert len(good & kept["quality rules"]) >= 0.95 * len(good)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == before
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, DATA).select("doc_id").collect()} == before


def test_every_operator_is_registered():
    assert [int(n[2:].split("_")[0]) for n in queries.queries()] == list(range(1, 14))
