"""A training corpus from raw documents, in five stages.

Every stage takes and returns whole rows of ``documents``; the last one returns the pieces
of the packed sequences. ``run`` writes each stage's result to the shared work folder and
reads it again for the next, so a lost executor costs at most the stage at hand.

Nulls, empty texts, repeated rows, empty tables and further columns are handled as the
stages' operators say: empty and null texts are scored like any other, one row of a group
of copies stays, and columns beyond those that a stage reads are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewise.llm.decontamination import decontaminate
from casewise.llm.packing import pack
from casewise.llm.quality_classifier import keep_good, train
from casewise.llm.secrets import redact_secrets
from casewise.llm.similar_texts import drop_similar
from casewise.llm.textops import read_table
from casewise.session import tune
from casewise.sources.workspace import fresh_path, remove_folder, run_folder


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, does not reject."""
    tune(spark)
    model = train(docs, read_table(spark, sf_dir, "labels"), F.lit(True))
    return keep_good(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near copies: those that the SimHash index links, and
    those that MinHash finds beyond its bits, if alike in 0.8 of their five-word shingles."""
    tune(spark)
    return drop_similar(docs)


def without_tests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    tune(spark)
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced."""
    tune(spark)
    return redact_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences that the documents are packed into."""
    tune(spark)
    return pack(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", one_of_each),
    ("benchmark_decontamination", without_tests),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

# The classifier is trained, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``.

    What a stage works with, and its input, go when its result is written.
    """
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"pipeline-{name}")
        with run_folder(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
