"""The pipeline's stages against brute force on the smallest sample."""

from __future__ import annotations

import brute
import public_tokenizers
import pytest

import corpus_pipeline
from tallymark.llm import bpe, quality
from tallymark.llm.components import components

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_rows_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    good = {r.doc_id for r in quality.score(docs, model).collect() if r.score >= 0.5}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.doc_id in good]
    rows = [(i, t) for i, _, _, t in brute.line_dedup(rows)]
    kept = {i for i, c, _ in brute.near(rows) if i == c}
    rows = [(i, t) for i, _, _, t in brute.substring_dedup([r for r in rows if r[0] in kept])]
    expected = brute.pieces(rows, bpe.tokenizer(public_tokenizers.path("word_bpe_49k.json")))
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert sorted(tuple(r)[:5] for r in out.collect()) == sorted(expected)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs_after = stage(spark, docs, FOLDER)
        assert docs_after.schema == docs.schema or docs_after.dtypes == docs.dtypes
        assert docs_after.where("n_chars <> length(text)").count() == 0


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, i) for i in range(201, 260)] + [(300, 301), (301, 302), (302, 300), (301, 300)]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert {found[i] for i in range(101)} == {0} and {found[i] for i in range(200, 260)} == {200} and found[302] == 300
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
