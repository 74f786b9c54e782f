"""The registered queries of the operators: thin, over whole tables, digests of real outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewise.llm.decontamination import contamination
from casewise.llm.language_id import languages
from casewise.llm.language_id import train as train_languages
from casewise.llm.license_scan import scan_licenses
from casewise.llm.manifest import FIELDS, dataset_manifest, digest
from casewise.llm.near_duplicates import near_duplicates
from casewise.llm.packing import pack
from casewise.llm.prefix_trie import trie, turn_lists, with_shared_heads
from casewise.llm.quality_classifier import THRESHOLD as GOOD
from casewise.llm.quality_classifier import scores as quality_scores
from casewise.llm.quality_classifier import train as train_quality
from casewise.llm.quality_rules import apply_rules
from casewise.llm.quality_rules import train as train_rules
from casewise.llm.secrets import BASE, count_kind, find_secrets, span_list
from casewise.llm.substring_dedup import drop_repeated_spans
from casewise.llm.textops import read_table
from casewise.llm.toxicity import THRESHOLD as TOXIC
from casewise.llm.toxicity import scores as toxicity_scores
from casewise.llm.toxicity import train as train_toxicity
from casewise.llm.training import remainder
from casewise.llm.vector_search import top_k


def _predicted(scored: DataFrame, held_out: Column, threshold: float) -> DataFrame:
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    held_out = remainder(5) == 0
    model = train_quality(documents, read_table(spark, sf_dir, "labels"), ~held_out)
    return _predicted(quality_scores(documents, model), held_out, GOOD)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda span: span["base"])
    starts = F.transform(base, lambda span: span["first_word"])

    def names(spans: Column) -> Column:
        labels = F.transform(spans, lambda span: span["label"])
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("spans")).alias("labels"),
        "score",
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    found = contamination(documents, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    model = train_rules(documents, read_table(spark, sf_dir, "labels"), F.lit(True))
    return apply_rules(documents, model)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_spans(read_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    held_out = remainder(3) == 1
    found = languages(documents, train_languages(documents, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    held_out = remainder(3) == 1
    model = train_toxicity(documents, read_table(spark, sf_dir, "labels"), ~held_out)
    return _predicted(toxicity_scores(documents, model), held_out, TOXIC)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read_table(spark, sf_dir, "documents"))
    names = F.array(*(F.lit(kind.name) for kind in BASE))
    base = F.filter("spans", lambda span: F.array_contains(names, span["kind"]))
    return found.select(
        "doc_id",
        *(count_kind(F.col("spans"), kind.name).alias(f"n_{kind.name}") for kind in BASE),
        F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)
    return found.select("query_id", "rank", "vec_id", "score")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {name: F.col(name) for name in FIELDS}
    longer = fields | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    touched = (remainder(7) == 0) & F.col("n_chars").isNotNull()
    leaf = digest(*fields.values())
    claim = F.when(touched, digest(*longer.values())).otherwise(leaf)
    documents = read_table(spark, sf_dir, "documents")
    found = dataset_manifest(documents, leaf, claim, tree=F.col("lang"), key=F.col("doc_id"))
    return found.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(with_shared_heads(turn_lists(read_table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_license_scan": op2_license_scan,
    "op3_decontamination": op3_decontamination,
    "op4_quality_rules": op4_quality_rules,
    "op5_packing": op5_packing,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_language_id": op7_language_id,
    "op8_toxicity": op8_toxicity,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_exact_top_k": op11_exact_top_k,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_prefix_trie": op13_prefix_trie,
}
