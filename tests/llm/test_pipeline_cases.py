"""Awkward rows through all stages but the last, and the last."""

from __future__ import annotations

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"


def test_nulls_repeats_and_further_columns_pass(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(20)
    said = " ".join(f"word{i}" for i in range(300))
    rows = [(None, None), (900001, None), (900002, ""), (900003, said), (900003, said), (None, said + " end"), (900004, " \n\n ")]
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], docs.schema)
    whole = docs.unionByName(odd).selectExpr("*", "'k' as __key", "1 as piece", "true as kept", "text as __text")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        before = whole
        whole = stage(spark, whole, FOLDER).cache()
        assert whole.columns == before.columns, name
        assert whole.where("text is null and __key <> 'k'").count() == 0
    ids = [r.doc_id for r in whole.collect()]
    assert ids.count(900003) <= 1 and 900001 in ids and 900002 in ids and 900004 in ids
    assert [r.text for r in whole.where("doc_id = 900001").collect()] == [None]
    packed = corpus_pipeline.STAGES[-1][1](spark, whole, FOLDER)
    lengths = {r.doc_id: r.length for r in packed.where("doc_id in (900001, 900002, 900004)").collect()}
    assert lengths == {900001: 1, 900002: 1, 900004: 1}


def test_an_empty_table_leaves_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0
