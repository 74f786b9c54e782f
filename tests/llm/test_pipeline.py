"""The pipeline's stages: each against what it must and must not do to its input."""

from __future__ import annotations

import corpus_pipeline

from casewise.llm.decontamination import contamination
from casewise.llm.quality_classifier import train
from casewise.llm.quality_classifier import scores as quality
from casewise.llm.secrets import find_secrets
from casewise.llm.textops import read_table
from casewise.sources.workspace import materialize
from pyspark.sql import functions as F
from similar_pairs import firsts_of_similar

SMALL = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = read_table(spark, SMALL, "documents")
    columns, inputs, outputs = docs.columns, {}, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        docs = outputs[name] = materialize(stage(spark, docs, SMALL), "test-stage")
        assert name == "packing" or docs.columns == columns

    def texts(df):
        return {row.doc_id: row.text for row in df.collect()}

    kept = texts(outputs["quality_classifier"])
    raw = texts(inputs["quality_classifier"])
    model = train(inputs["quality_classifier"], read_table(spark, SMALL, "labels"), F.lit(True))
    good = {r.doc_id for r in quality(inputs["quality_classifier"], model).where("score >= 0.3").collect()}
    assert kept == {i: raw[i] for i in good}

    once = texts(outputs["simhash_near_dedup"])
    assert once == {i: kept[i] for i in firsts_of_similar(kept)}

    items = read_table(spark, SMALL, "benchmark")
    clean = texts(outputs["benchmark_decontamination"])
    before = {r.doc_id: r for r in contamination(inputs["benchmark_decontamination"], items).collect()}
    assert not contamination(outputs["benchmark_decontamination"], items).where("contaminated").count()
    for i, text in once.items():
        if not before[i].contaminated:
            assert clean[i] == text
        else:
            assert (i in clean) == (before[i].n_hit <= 0.5 * before[i].n_words)

    redacted = texts(outputs["secret_scan"])
    spans = {r.doc_id: r.spans for r in find_secrets(inputs["secret_scan"]).collect()}
    assert set(redacted) == set(clean)
    for i, text in clean.items():
        assert (redacted[i] == text) == (not spans[i])
        assert all(text[s.start : s.stop] not in redacted[i] for s in spans[i])

    pieces = outputs["packing"].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert {r.doc_id for r in pieces.collect()} == set(redacted)
    assert all(r.n == r["all"] for r in pieces.collect())

    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, outputs["packing"].collect()))


def test_empty_documents(spark, nothing):
    docs = nothing
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0


def test_awkward_documents(spark, awkward):
    docs = awkward
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SMALL), "test-stage")
    assert docs.where("doc_tokens IS NULL").count() == 0


def test_no_sql_for_the_pipeline():
    assert corpus_pipeline.ORACLE_SQL is None
