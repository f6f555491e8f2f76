"""The pipeline: each stage judged on what the one before kept."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from spokecast.llm import toxicity


def test_stages_against_brute_force(spark, sf_dir):
    from test_llm_operators import brute_components, brute_repeats

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = {r.doc_id for r in toxicity.score(docs, toxicity.fit(docs, labels)).where("score < 0.5").collect()}
    stage = [f for _, f in corpus_pipeline.STAGES]
    clean = stage[0](spark, docs, sf_dir).checkpoint()
    assert {r.doc_id for r in clean.collect()} == scored and clean.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    single = stage[1](spark, clean, sf_dir).checkpoint()
    want = {i for i, (_, root) in brute_components(rows, 5, 80).items() if root == i}
    assert {r.doc_id for r in single.collect()} == want
    rows = [(r.doc_id, r.text) for r in single.collect()]
    cut = stage[2](spark, single, sf_dir).checkpoint()
    kept = brute_repeats(rows)
    assert {r.doc_id: " ".join(r.text.split()) for r in cut.collect()} == kept and cut.columns == docs.columns
    assert cut.where(F.col("n_chars") != F.length("text")).count() == single.where(F.col("n_chars") != F.length("text")).count()
    free = stage[3](spark, cut, sf_dir)
    assert free.columns == docs.columns and free.count() <= cut.count()
    assert stage[4](spark, free, sf_dir).where(F.size("ids") != F.col("n_tokens")).count() == 0


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids", "text_sha256"] and out.count() > 0
