"""Every operator on awkward and on empty tables: a defined row for each document."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from casewise.llm.decontamination import contamination, decontaminate
from casewise.llm.language_id import languages
from casewise.llm.language_id import train as train_languages
from casewise.llm.license_scan import scan_licenses
from casewise.llm.near_duplicates import drop_near_duplicates, near_duplicates
from casewise.llm.packing import pack
from casewise.llm.quality_classifier import keep_good
from casewise.llm.quality_classifier import scores as quality
from casewise.llm.quality_classifier import train as train_quality
from casewise.llm.quality_rules import apply_rules
from casewise.llm.quality_rules import train as train_rules
from casewise.llm.secrets import find_secrets, redact_secrets
from casewise.llm.substring_dedup import drop_repeated_spans
from casewise.llm.toxicity import scores as toxicity
from casewise.llm.toxicity import train as train_toxicity

def every():
    return F.lit(True)



@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (3, 0, 1), (4, 1, 0), (4, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def no_labels(labels):
    return labels.limit(0)


def _operators(docs, labels, items):
    return {
        "quality": quality(docs, train_quality(docs, labels, every())),
        "licenses": scan_licenses(docs),
        "contamination": contamination(docs, items),
        "rules": apply_rules(docs, train_rules(docs, labels, every())),
        "spans": drop_repeated_spans(docs),
        "languages": languages(docs, train_languages(docs, every())),
        "toxicity": toxicity(docs, train_toxicity(docs, labels, every())),
        "near": near_duplicates(docs),
        "secrets": find_secrets(docs),
    }


def test_a_row_for_each_document(awkward, labels, benchmark_items):
    ids = sorted((row.doc_id is None, row.doc_id or 0) for row in awkward.select("doc_id").collect())
    for name, result in _operators(awkward, labels, benchmark_items).items():
        found = [row.doc_id for row in result.select("doc_id").collect()]
        assert sorted((i is None, i or 0) for i in found) == ids, name


def test_packing_has_every_document(awkward):
    pieces = pack(awkward).select("doc_id", "length", "doc_tokens").collect()
    assert {row.doc_id for row in pieces} == {None, *range(1, 10)}
    assert sum(row.length for row in pieces if row.doc_id == 3) == next(
        row.doc_tokens for row in pieces if row.doc_id == 3
    )
    assert [row.length for row in pieces if row.doc_id == 2] == [1]


def test_empty_tables(nothing, no_labels, benchmark_items):
    for name, result in _operators(nothing, no_labels, benchmark_items.limit(0)).items():
        assert result.count() == 0, name
    assert pack(nothing).count() == 0


def test_no_labels_and_no_items(awkward, no_labels, benchmark_items):
    assert {row.score for row in quality(awkward, train_quality(awkward, no_labels, every())).collect()} == {0.5}
    assert {row.score for row in toxicity(awkward, train_toxicity(awkward, no_labels, every())).collect()} == {0.5}
    assert {row.chance for row in apply_rules(awkward, train_rules(awkward, no_labels, every())).collect()} == {0.5}
    assert not contamination(awkward, benchmark_items.limit(0)).where("contaminated").count()
    unnamed = awkward.withColumn("lang", F.lit(None).cast("string"))
    found = languages(unnamed, train_languages(unnamed, every())).collect()
    assert {row.lang_pred for row in found} == {"und"}


def test_stages_keep_the_columns(awkward, labels, benchmark_items):
    stages = {
        "good": keep_good(awkward, train_quality(awkward, labels, every()), 0.0),
        "decontaminated": decontaminate(awkward, benchmark_items),
        "redacted": redact_secrets(awkward),
        "unique": drop_near_duplicates(awkward),
    }
    for name, result in stages.items():
        assert result.columns == awkward.columns, name
        assert result.where("doc_id = 3 AND score = 7 AND key = 8 AND found = 'f'").count() == 1, name
    for name in ("good", "decontaminated", "redacted"):
        before, after = awkward.collect(), stages[name].collect()
        assert sorted(map(repr, before)) == sorted(map(repr, after)), name


def test_one_of_each_copy(awkward):
    kept = drop_near_duplicates(awkward).collect()
    assert sum(row.doc_id == 4 for row in kept) == 1
    # Null, empty and blank texts share fingerprint zero; the smallest id stays.
    assert [row.doc_id for row in kept if not (row.text or "").strip()] == [1]
