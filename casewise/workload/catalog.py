"""The registered queries: name to (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewise import functions as fn
from casewise.operators import assessment, gates, nesting, scoring, signals, silver, windows
from casewise.operators.assessors import calling_assessor, case_text, rule_assessor, with_reply
from casewise.plans.chain import run_all
from casewise.plans.enrichment import assess_in_waves, compact_cache
from casewise.plans.landing import bronze_path, land, landed_path, rejected_path
from casewise.plans.transform import run_transform
from casewise.schema import (
    DRUG_ROLE_CODES,
    REACTION_OUTCOME_CODES,
    SERIOUS_CODES,
    SEX_CODES,
)
from casewise.sources import (
    decode_lines,
    fresh_path,
    materialize,
    read_assessments,
    read_bronze,
    read_cases,
    read_silver,
    split_corrupt,
    union_bronze,
    write_partitioned_ndjson,
)
from casewise.sources.bronze import PARTLY_READ, RAW_LINE
from casewise.sources.cached import append_replies, read_replies
from casewise.sources.commits import drop_commit, has_commit
from casewise.sources.sinks import RECORDS_PER_FILE
from casewise.streaming import (
    BROKEN,
    SEQUENCE,
    committed,
    compact_landed,
    counted_messages,
    file_messages,
    keyed_messages,
    land_distinct,
    land_stream,
    max_offsets,
    publish_in_order,
    publish_to_files,
    read_distinct,
    read_landed,
    stream_id,
    to_files,
)
from casewise.workload import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MODEL, PROMPT = "model-a", "v1"


def query(function: Query) -> Query:
    """Register under the function's name; a trailing underscore avoids a module's name."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def _joined(array: Column) -> Column:
    return F.array_join(array, ";")


# --- scans -----------------------------------------------------------------------


@query
def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = split_corrupt(read_bronze(spark, tables.document_files(spark, sf_dir, quick=True)))
    return documents.select(
        "safetyreportid",
        "safetyreportversion",
        "companynumb",
        F.col("primarysource.qualification").alias("qualification"),
        F.col("patient.patientonsetage").alias("age_text"),
        fn.safe_size(F.col("patient.drug")).alias("drug_count"),
        fn.first_element(F.col("patient.drug"))["activesubstance"]["activesubstancename"].alias(
            "first_substance"
        ),
        fn.first_element(F.col("patient.reaction"))["reactionmeddrapt"].alias("first_term"),
    )


@query
def ndjson_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain and gzipped files with blank lines between the events and a torn line behind
    each event of type ``error``, in one folder; every line that is not blank comes back."""
    path = fresh_path(spark, "ndjson")
    event = tables.event_documents(spark, sf_dir)
    torn = F.when(F.col("event_type") == "error", tables.torn_line())
    text = F.array_compact(F.array(F.to_json(F.struct("*")), F.lit(""), torn))
    line = event.select("event_type", F.explode(text).alias("value"))
    zipped = F.col("event_type") == "click"
    line.filter(~zipped).select("value").write.text(path)
    line.filter(zipped).select("value").write.mode("append").option("compression", "gzip").text(path)
    return read_bronze(spark, path, tables.EVENT_SCHEMA).select(
        "event_id", "user_id", "event_type", "value", RAW_LINE
    )


@query
def eval_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "assessments")
    place = {"ingest_date": F.col("assessment.confidence"), "run_id": "run-1"}
    write_partitioned_ndjson(tables.text_enriched(spark, sf_dir), path, place)
    return read_assessments(spark, path).select(
        "safetyreportid",
        F.col("assessment.seriousness").alias("seriousness"),
        F.col("assessment.primary_suspect").alias("primary_suspect"),
        F.col("assessment.confidence").alias("confidence"),
        "latency_ms",
        "cached",
        "label_seriousness",
        _joined(F.col("input_substances")).alias("substances"),
    )


@query
def corrupt_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "lines")
    tables.event_lines(spark, sf_dir).write.text(path)
    scan = read_bronze(spark, path, tables.EVENT_SCHEMA)
    good, broken = split_corrupt(scan)
    return good.select(
        F.lit("document").alias("kind"), "event_id", F.lit(None).cast("string").alias("raw_line")
    ).unionByName(
        broken.select(F.lit("broken").alias("kind"), F.lit(None).cast("bigint").alias("event_id"), "raw_line")
    )


@query
def bronze_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents from the batch side, those with a fatal flag again from the stream side."""
    batch = tables.documents(spark, sf_dir)
    streamed = batch.filter(F.col("seriousnessdeath") == "1").drop("duplicate")
    both = union_bronze(batch, streamed)
    return both.groupBy("serious").agg(
        F.count(F.lit(1)).alias("documents"),
        F.count("duplicate").alias("with_duplicate_flag"),
    )


# --- scalars ---------------------------------------------------------------------


@query
def decode_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.documents(spark, sf_dir).select(
        "safetyreportid",
        "companynumb",
        fn.decode(F.col("serious"), SERIOUS_CODES).alias("seriousness"),
        fn.decode(F.col("patient.patientsex"), SEX_CODES).alias("sex"),
        fn.decode(
            fn.first_element(F.col("patient.drug"))["drugcharacterization"], DRUG_ROLE_CODES
        ).alias("first_role"),
        fn.decode(
            fn.first_element(F.col("patient.reaction"))["reactionoutcome"], REACTION_OUTCOME_CODES
        ).alias("first_outcome"),
    )


@query
def partial_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    value, fmt = F.col("receiptdate"), F.col("receiptdateformat")
    return tables.documents(spark, sf_dir).select(
        "safetyreportid",
        "companynumb",
        fn.parse_partial_date(value, fmt).alias("receipt_date"),
        fn.date_precision(value, fmt).alias("precision"),
        fn.compact_date(fn.parse_partial_date(value, fmt)).alias("compact"),
    )


@query
def normalize_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("\t  "), F.lower("p_name"), F.lit(" \r\n　"))
    blank = F.when(F.col("p_size") > 25, F.lit(" \t ")).otherwise(F.col("p_type"))
    return tables.table(spark, sf_dir, "part").select(
        "p_partkey",
        fn.normalize_term(padded).alias("term"),
        fn.blank_to_null(fn.normalize_term(blank)).alias("blank_term"),
    )


def _cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nesting.cases_from_documents(tables.latest(spark, sf_dir))


@query
def content_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = assessment.with_content_key(_cases(spark, sf_dir), MODEL, PROMPT)
    return keyed.select("safetyreportid", "content_key")


@query
def render_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cases(spark, sf_dir).select("safetyreportid", case_text().alias("text"))


# --- silver ----------------------------------------------------------------------


@query
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.latest(spark, sf_dir).select(
        "safetyreportid", "safetyreportversion", "receiptdate", "companynumb"
    )


@query
def report_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.report_table(tables.latest(spark, sf_dir))


@query
def explode_drugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.drug_table(tables.latest(spark, sf_dir))


@query
def explode_reactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.reaction_table(tables.latest(spark, sf_dir))


# --- nesting ---------------------------------------------------------------------


def _flat_cases(cases: DataFrame) -> DataFrame:
    def line(item: Column, *names: str) -> Column:
        return F.concat_ws("|", *(F.coalesce(item[name], F.lit("-")) for name in names))

    return cases.select(
        "safetyreportid",
        "patient_sex",
        "patient_onset_age",
        "occur_country",
        "label_seriousness",
        _joined(
            F.transform(
                "drugs",
                lambda d: line(d, "active_substance", "medicinal_product", "drug_role", "indication"),
            )
        ).alias("drugs"),
        _joined(
            F.transform("reactions", lambda r: line(r, "reaction_term", "reaction_outcome"))
        ).alias("reactions"),
    )


@query
def nest_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_cases(_cases(spark, sf_dir))


@query
def nest_cases_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = materialize(tables.latest(spark, sf_dir), "latest")
    return _flat_cases(nesting.cases_from_tables(*silver.silver_tables(latest)))


@query
def capped_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_cases(nesting.cap_cases(_cases(spark, sf_dir), 50))


# --- signals ---------------------------------------------------------------------


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.pairs_from_documents(tables.latest(spark, sf_dir, signals.PAIR_SCHEMA))


@query
def pair_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = materialize(tables.latest(spark, sf_dir), "latest")
    return signals.pairs_from_tables(silver.drug_table(latest), silver.reaction_table(latest))


@query
def pair_build_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir)


@query
def pair_build_all_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = tables.latest(spark, sf_dir, signals.PAIR_SCHEMA)
    return signals.pairs_from_documents(latest, suspect_only=False)


@query
def pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.pair_counts(_pairs(spark, sf_dir))


@query
def prr_contingency(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = materialize(signals.pair_counts(_pairs(spark, sf_dir)), "pair-counts")
    return signals.contingency(counts)


@query
def prr_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.build_signals(_pairs(spark, sf_dir))


@query
def prr_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with a zero cell, with the correction and without it."""
    counts = materialize(signals.pair_counts(_pairs(spark, sf_dir)), "pair-counts")
    table = signals.contingency(counts)
    plain = signals.score_pairs(table, correction=0.0).select(
        *signals.PAIR, F.col("prr").alias("uncorrected_prr")
    )
    sparse = signals.score_pairs(table).filter("continuity_corrected")
    return sparse.join(plain, list(signals.PAIR))


@query
def prr_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's top 20."""
    ranked = signals.rank_signals(signals.build_signals(_pairs(spark, sf_dir)))
    return ranked.limit(20).select(*signals.PAIR, "report_count", "prr", "meets_min_count")


# --- gates -----------------------------------------------------------------------


@query
def gates_(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = silver.report_table(tables.latest(spark, sf_dir))
    return gates.check_frame(
        report,
        [
            gates.row_count(1),
            gates.row_count(1, 10),
            gates.not_null("safetyreportid"),
            gates.not_null("reporter_country"),
            gates.null_rate("receipt_date", 0.05),
            gates.null_rate("receipt_date", 0.5),
        ],
    )


@query
def gate_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniqueness before and after the version cut."""
    keys = [gates.unique("safetyreportid"), gates.unique("safetyreportid", "receiptdateformat")]
    named = tables.documents(spark, sf_dir).select("safetyreportid", "receiptdateformat")
    before = gates.check_frame(materialize(named, "documents"), keys)
    after = gates.check_frame(tables.latest(spark, sf_dir), keys[:1])
    return before.withColumn("stage", F.lit("bronze")).unionByName(
        after.withColumn("stage", F.lit("latest"))
    )


@query
def gate_ordering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date ordering by day, and with month dates compared by month."""
    report = silver.report_table(tables.latest(spark, sf_dir))
    strict = gates.check_frame(report, [gates.date_ordering("receive_date", "receipt_date")])
    coarse = gates.check_frame(
        report, [gates.date_ordering("receive_date", "receipt_date", "receipt_date_precision")]
    )
    return strict.withColumn("compared", F.lit("day")).unionByName(
        coarse.withColumn("compared", F.lit("precision"))
    )


@query
def stage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole transform over landed documents; one row per stage."""
    bronze = tables.document_files(spark, sf_dir)
    stats = run_transform(
        spark, bronze, fresh_path(spark, "silver"), fresh_path(spark, "gold"), max_null_rate=0.6
    )
    return spark.createDataFrame(list(stats.items()), "stage STRING, n BIGINT")


def _transformed(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Silver and gold folders that the whole transform has written."""
    out, gold = fresh_path(spark, "silver"), fresh_path(spark, "gold")
    run_transform(spark, tables.document_files(spark, sf_dir), out, gold, max_null_rate=0.6)
    return out, gold


@query
def written_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_silver(spark, _transformed(spark, sf_dir)[0])[0]


@query
def written_drugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_silver(spark, _transformed(spark, sf_dir)[0])[1]


@query
def written_reactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_silver(spark, _transformed(spark, sf_dir)[0])[2]


@query
def written_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_cases(read_cases(spark, f"{_transformed(spark, sf_dir)[0]}/enrichment_input"))


@query
def written_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{_transformed(spark, sf_dir)[1]}/drug_reaction_signals")


@query
def run_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing, transform, assessment and scoring of all documents, one after another."""
    document = tables.documents(spark, sf_dir)
    received = fn.parse_partial_date(F.col("receivedate"), F.col("receivedateformat"))
    start, end = document.select(received.alias("day")).agg(F.min("day"), F.max("day")).first()
    order = [F.col("safetyreportid"), F.col("companynumb")]
    result = run_all(
        document,
        received,
        order,
        start,
        end,
        fresh_path(spark, "chain"),
        rule_assessor,
        "rules",
        transform={"max_null_rate": 0.6},
    )
    scores = result["evaluation"]
    counts = {
        "landed": result["landed"],
        **result["transform"],
        **{name: result["enrichment"][name] for name in ("attempted", "enriched", "dead_lettered")},
        **{name: scores[name] for name in ("n_scored", "n_unlabeled", "tp", "fp", "tn", "fn")},
    }
    return spark.createDataFrame(list(counts.items()), "stage STRING, n BIGINT")


# --- evaluation ------------------------------------------------------------------


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.labelled(tables.text_enriched(spark, sf_dir))


@query
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.confusion(_labelled(spark, sf_dir))


@query
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.classification_metrics(scoring.confusion(_labelled(spark, sf_dir)))


@query
def majority_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    joint = scoring.joint_counts(_labelled(spark, sf_dir))
    return scoring.majority_baseline(joint).withColumn(
        "majority_accuracy", F.round("majority_accuracy", 4)
    )


@query
def cohens_kappa(spark: SparkSession, sf_dir: str) -> DataFrame:
    joint = scoring.joint_counts(_labelled(spark, sf_dir))
    return scoring.cohens_kappa(joint).select(F.round("cohens_kappa", 4).alias("cohens_kappa"))


@query
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.calibration(_labelled(spark, sf_dir))


@query
def grounding_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.grounding(tables.text_enriched(spark, sf_dir))


@query
def grounding_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.grounding_examples(tables.text_enriched(spark, sf_dir)).withColumn(
        "available", _joined(F.col("available"))
    )


@query
def price_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of a number that is no integer."""
    line = tables.table(spark, sf_dir, "lineitem")
    return scoring.percentiles(line, "l_extendedprice", (0, 5, 50, 95, 100))


@query
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.latency_percentiles(
        tables.text_enriched(spark, sf_dir), (0, 1, 25, 50, 75, 95, 99, 100)
    )


@query
def eval_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.report(tables.text_enriched(spark, sf_dir))


# --- assessment ------------------------------------------------------------------


def _flat_assessment(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(
        *columns,
        F.col("assessment.seriousness").alias("seriousness"),
        F.col("assessment.primary_suspect").alias("primary_suspect"),
        F.array_size("assessment.key_reactions").alias("key_reaction_count"),
        F.col("assessment.confidence").alias("confidence"),
    )


@query
def assess_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = assessment.validate_replies(rule_assessor(_cases(spark, sf_dir)))
    return _flat_assessment(
        replies, "safetyreportid", "input_tokens", "output_tokens", "latency_ms"
    )


@query
def assess_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Python call per case inside tasks; this one echoes the rendered text."""

    def echo(text: str) -> dict:
        return {"raw_reply": text, "input_tokens": len(text), "output_tokens": text.count("\n") + 1}

    replies = calling_assessor(echo)(tables.text_cases(spark, sf_dir), 1)
    return replies.select(
        "safetyreportid",
        F.sha2("raw_reply", 256).alias("reply_digest"),
        "input_tokens",
        "output_tokens",
        "latency_ms",
        "call_error",
    )


@query
def validate_assessments(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = tables.uneven_assessor(tables.text_cases(spark, sf_dir), 1)
    return _flat_assessment(
        assessment.validate_replies(first).withColumn("errors", _joined(F.col("errors"))),
        "safetyreportid",
        "errors",
        "call_error",
    )


@query
def validate_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies whose fields have the wrong JSON types: a number, an object, a mixed list."""
    case = tables.text_cases(spark, sf_dir)
    number = F.pmod(F.col("safetyreportid").cast("int"), F.lit(5))
    start = '{"seriousness":"serious","confidence":"low"'
    reply = (
        F.when(number == 0, start + ',"rationale":123}')
        .when(number == 1, start + ',"rationale":"r","primary_suspect":5}')
        .when(number == 2, start + ',"rationale":"r","key_reactions":[1,{"a":2}]}')
        .when(number == 3, start + ',"rationale":{"a":"b"},"primary_suspect":["x"],"key_reactions":"x"}')
        .otherwise(start + ',"rationale":"r","primary_suspect":null,"key_reactions":["a","b"]}')
    )
    replied = with_reply(case, reply, F.lit(1), F.lit(1), F.lit(1))
    return assessment.validate_replies(replied).select(
        "safetyreportid",
        _joined(F.col("errors")).alias("errors"),
        _joined(F.col("assessment.key_reactions")).alias("key_reactions"),
    )


def _outcomes(spark: SparkSession, sf_dir: str, cached: bool = False) -> DataFrame:
    cases = tables.text_cases(spark, sf_dir)
    cache = None
    if cached:
        keyed = assessment.with_content_key(cases, MODEL, PROMPT)
        cache = materialize(tables.text_cache(spark, sf_dir, keyed), "cache")
    return assessment.assess_cases(cases, tables.uneven_assessor, MODEL, PROMPT, cache)


@query
def retry_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _outcomes(spark, sf_dir)
        .groupBy("status", "attempts", "reason")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("billed_input_tokens").alias("billed_input_tokens"),
            F.sum("billed_output_tokens").alias("billed_output_tokens"),
        )
    )


@query
def dlq_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs of a run; the landed row and the dead letter of no case overlap."""
    outcomes = _outcomes(spark, sf_dir)
    landed = assessment.enriched_rows(outcomes).withColumns(
        {
            "output": F.lit("assessments"),
            "suspect": F.col("assessment.primary_suspect"),
            "reason": F.lit(None).cast("string"),
            "raw_response": F.lit(None).cast("string"),
        }
    )
    dead = assessment.dead_letters(outcomes).withColumns(
        {"output": F.lit("dlq"), "suspect": F.lit(None).cast("string")}
    )
    columns = ["safetyreportid", "output", "suspect", "reason", "raw_response"]
    return landed.select(columns).unionByName(dead.select(columns))


@query
def enrich_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assessment.run_metrics(_outcomes(spark, sf_dir, cached=True))


@query
def cache_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = assessment.with_content_key(tables.text_cases(spark, sf_dir), MODEL, PROMPT)
    cache = materialize(tables.text_cache(spark, sf_dir, keyed), "cache")
    hits, misses = assessment.split_by_cache(keyed, cache)
    return hits.select(
        "safetyreportid", F.lit(True).alias("hit"), "input_tokens", "latency_ms"
    ).unionByName(
        misses.select(
            "safetyreportid",
            F.lit(False).alias("hit"),
            F.lit(None).cast("bigint").alias("input_tokens"),
            F.lit(None).cast("int").alias("latency_ms"),
        )
    )


@query
def cache_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache of all cases, landed twice and compacted; the Spanish cases of one source look it up."""
    keyed = assessment.with_content_key(tables.text_cases(spark, sf_dir), MODEL, PROMPT)
    whole, small = fresh_path(spark, "cache"), fresh_path(spark, "cache")
    entries = materialize(tables.text_cache(spark, sf_dir, keyed), "entries")
    for _ in range(2):
        append_replies(entries, whole)
    compact_cache(spark, whole, small)
    asking = keyed.where("occur_country = 'es' AND drugs[0].active_substance = 'src1'")
    hits, _ = assessment.split_by_cache(asking, read_replies(spark, small, asking))
    return hits.select("safetyreportid", "input_tokens", "latency_ms")


@query
def assess_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assessment in waves, broken off after the second and taken up again by a new run."""
    cases = materialize(tables.text_cases(spark, sf_dir), "cases")
    resume, asked = fresh_path(spark, "resume"), []

    class BrokenOff(Exception):
        pass

    def failing(case: DataFrame, attempt: int) -> DataFrame:
        if attempt == 1 and len(asked) == 2:
            raise BrokenOff
        asked.extend([attempt] if attempt == 1 else [])
        return tables.uneven_assessor(case, attempt)

    def run(assessor) -> DataFrame:
        return assess_in_waves(cases, assessor, MODEL, PROMPT, None, 4, resume)

    try:
        run(failing)
    except BrokenOff:
        pass
    outcomes = run(tables.uneven_assessor)
    return outcomes.select("safetyreportid", "status", "attempts", "reason", "billed_input_tokens")


# --- ingest ----------------------------------------------------------------------


def _event_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("ts").cast("date")
    return tables.table(spark, sf_dir, "events").agg(F.min(day).alias("start"), F.max(day).alias("end"))


@query
def ingest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window of the events' range with its bounds and its number of events."""
    bounds = _event_range(spark, sf_dir)
    planned = windows.windows_between(bounds)
    event = tables.table(spark, sf_dir, "events")
    start = bounds.select("start").scalar()
    end = bounds.select("end").scalar()
    assigned = windows.assign_window(event, F.col("ts").cast("date"), start, end)
    totals = windows.window_totals(planned, assigned, F.lit(0).cast("decimal(20,0)"))
    return totals.select(
        fn.compact_date(F.col("window_start")).alias("first_day"),
        fn.compact_date(F.col("window_end")).alias("last_day"),
        "records",
    )


@query
def window_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 500 events per window, the earliest ones."""
    bounds = _event_range(spark, sf_dir)
    event = tables.table(spark, sf_dir, "events")
    assigned = windows.assign_window(
        event,
        F.col("ts").cast("date"),
        bounds.select("start").scalar(),
        bounds.select("end").scalar(),
    )
    order = [F.col("ts"), F.col("event_id")]
    return windows.cap_per_window(assigned, order, 500).select(
        "event_id", "user_id", "window_start", "window_end"
    )


@query
def range_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with each of the windows it is in: uneven, overlapping ones, one per nation."""
    first = _event_range(spark, sf_dir).select("start").scalar()
    key = F.col("n_nationkey")
    begin = F.date_add(first, (F.pmod(key * 13, F.lit(60)) - 15).cast("int"))
    length = F.element_at(F.array(*map(F.lit, (1, 2, 3, 5, 10, 21, 45))), (F.pmod(key, F.lit(7)) + 1).cast("int"))
    window = tables.table(spark, sf_dir, "nation")
    window = window.select("n_name", begin.alias("first_day"), F.date_add(begin, length - 1).alias("last_day"))
    event = tables.table(spark, sf_dir, "events").select("event_id", "ts")
    met = windows.join_windows(event, F.col("ts").cast("date"), window, "first_day", "last_day")
    return met.select("event_id", "n_name", "first_day", "last_day")


@query
def run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events landed without a cap; the manifest's counts and checksum."""
    event = tables.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    bounds: tuple[date, date] = _event_range(spark, sf_dir).first()
    manifest = land(
        event.withColumn("day", F.col("ts").cast("date").cast("string")).drop("ts"),
        F.col("day").cast("date"),
        [F.col("event_id")],
        *bounds,
        root=fresh_path(spark, "landing"),
        dataset="events",
        ingest_date="2024-02-01",
        run_id="run-1",
    )
    return manifest.select(
        "dataset",
        "ingest_date",
        "run_id",
        "status",
        "record_count",
        "window_count",
        "content_checksum",
        _joined(F.transform("windows", lambda w: w["records"].cast("string"))).alias("window_records"),
        F.size(F.filter("windows", lambda w: w["records"] > 0)).alias("filled_windows"),
    )


def _event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that can be read as records; every tenth user's have no day."""
    day = F.when(F.col("user_id") % 10 != 0, F.col("ts").cast("date").cast("string"))
    event = tables.table(spark, sf_dir, "events").where("event_type <> 'error'")
    return event.select("event_id", "user_id", "event_type", day.alias("day"))


def _torn_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other events, as lines that broke off."""
    torn = tables.event_documents(spark, sf_dir).where("event_type = 'error'")
    return torn.select(tables.torn_line().alias(RAW_LINE))


@query
def land_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with what became of it, as read back from the landed and rejected files."""
    start, end = _event_range(spark, sf_dir).first()
    start, end = start + timedelta(days=3), end - timedelta(days=3)
    root = fresh_path(spark, "landing")
    land(
        _event_records(spark, sf_dir),
        F.col("day").cast("date"),
        [F.col("event_id")],
        start,
        end,
        root=root,
        dataset="events",
        ingest_date="2024-02-01",
        max_records_per_window=300,
        broken=_torn_events(spark, sf_dir),
    )
    place = (root, "events", "2024-02-01", start, end)
    schema = f"event_id BIGINT, {RAW_LINE} STRING, reason STRING"
    rejected = spark.read.schema(schema).json(rejected_path(*place))
    landed = spark.read.schema(schema).json(landed_path(*place)).withColumn("reason", F.lit("landed"))
    return landed.unionByName(rejected).select("event_id", RAW_LINE, F.col("reason").alias("fate"))


@query
def land_two_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ranges landed on one date, the first of them twice: all events with what became of
    each in either range, read back."""
    start, end = _event_range(spark, sf_dir).first()
    middle = start + (end - start) // 2
    root = fresh_path(spark, "landing")
    ranges = ((start, middle), (middle + timedelta(days=1), end))
    for first, last in (*ranges, ranges[0]):
        land(
            _event_records(spark, sf_dir),
            F.col("day").cast("date"),
            [F.col("event_id")],
            first,
            last,
            root=root,
            dataset="events",
            ingest_date="2024-02-01",
            broken=_torn_events(spark, sf_dir),
        )
    schema = T.StructType.fromDDL("event_id BIGINT, user_id BIGINT, event_type STRING, day STRING")
    landed = split_corrupt(read_bronze(spark, bronze_path(root, "events"), schema))[0]
    fates = [landed.withColumns({RAW_LINE: F.lit(None).cast("string"), "fate": F.lit("landed")})]
    for first, last in ranges:
        place = (root, "events", "2024-02-01", first, last)
        rejected = spark.read.schema(T.StructType([*schema.fields]).add(RAW_LINE, T.StringType()).add("reason", T.StringType()))
        fates.append(rejected.json(rejected_path(*place)).withColumnRenamed("reason", "fate"))
    return fates[0].unionByName(fates[1]).unionByName(fates[2])


# --- streaming -------------------------------------------------------------------


def _topic_files(spark: SparkSession, lines: DataFrame) -> str:
    path = fresh_path(spark, "topic")
    lines.select("value").write.text(path)
    return path


def _write_zipped(lines: DataFrame, path: str) -> None:
    """Whole documents as lines take a tenth of the disk so."""
    lines.write.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages streamed to landed files; documents and broken messages together."""
    messages = file_messages(spark, _topic_files(spark, tables.event_lines(spark, sf_dir)))
    landed = fresh_path(spark, "landed")
    land_stream(
        decode_lines(messages, tables.EVENT_SCHEMA),
        landed,
        fresh_path(spark, "checkpoint"),
        ingest_date=F.lit("2024-02-01"),
    ).awaitTermination()
    good = read_landed(spark, landed, tables.EVENT_SCHEMA)
    broken = read_landed(spark, landed, kind=BROKEN)
    return good.withColumn("raw_line", F.lit(None).cast("string")).unionByName(
        broken, allowMissingColumns=True
    )


@query
def stream_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with checkpoints of their own into one folder."""
    event = tables.event_documents(spark, sf_dir)
    landed = fresh_path(spark, "landed")
    for part in (0, 1):
        lines = event.where(F.col("event_id") % 2 == part).select(F.to_json(F.struct("*")).alias("value"))
        decoded = decode_lines(file_messages(spark, _topic_files(spark, lines)), tables.EVENT_SCHEMA)
        land_stream(decoded, landed, fresh_path(spark, "checkpoint")).awaitTermination()
    return read_landed(spark, landed, tables.EVENT_SCHEMA)


@query
def stream_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents streamed with all torn messages of the events among them, then transformed from the
    landed folder: the torn ones are what goes to quarantine."""
    line = F.to_json(F.struct("*")).alias("value")
    documents = tables.documents(spark, sf_dir).select(line)
    messages = documents.unionByName(tables.event_lines(spark, sf_dir).where("NOT endswith(value, '}')"))
    topic, landed, out = (fresh_path(spark, name) for name in ("topic", "landed", "silver"))
    _write_zipped(messages, topic)
    decoded = decode_lines(file_messages(spark, topic))
    land_stream(decoded, landed, fresh_path(spark, "checkpoint")).awaitTermination()
    gold = fresh_path(spark, "gold")
    run_transform(spark, landed, out, gold, max_null_rate=0.6, max_corrupt_rate=0.9)
    report = read_silver(spark, out)[0].select("safetyreportid", "seriousness", "drug_count")
    lost = spark.read.parquet(f"{out}/quarantine")
    return report.withColumn(RAW_LINE, F.lit(None).cast("string")).unionByName(
        lost, allowMissingColumns=True
    )


@query
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which older versions could be read in part only: every such line is kept,
    and the newest versions are the reports."""
    document = tables.documents(spark, sf_dir)
    whole = F.to_json(F.struct("*"))
    torn = F.concat(F.expr("left(_torn, length(_torn) - 1)"), F.lit(',"patient":"lost"}'))
    bare = F.to_json(F.struct(*(name for name in document.columns if name != "patient")))
    old = F.coalesce(F.col("safetyreportversion").try_cast("int") <= 10, F.lit(False))
    lines = document.select(old.alias("_old"), whole.alias("_whole"), bare.alias("_torn"))
    path, out, gold = (fresh_path(spark, name) for name in ("partly", "silver", "gold"))
    _write_zipped(lines.select(F.when(F.col("_old"), torn).otherwise(F.col("_whole")).alias("value")), path)
    run_transform(spark, path, out, gold, max_null_rate=1.0, max_corrupt_rate=1.0)
    names = ["safetyreportid", "safetyreportversion", "companynumb"]
    report = read_silver(spark, out)[0].withColumnRenamed("company_number", "companynumb")
    said = F.from_json(RAW_LINE, ", ".join(f"{name} STRING" for name in names))
    lost = spark.read.parquet(f"{out}/quarantine").select(said.alias("said")).select("said.*")
    return report.select(*names, F.lit("report").alias("output")).unionByName(
        lost.select(*names, F.lit("quarantine").alias("output"))
    )


def _distinct(spark: SparkSession, parts: list[DataFrame], delay: str) -> DataFrame:
    """The parts sent one after the other, a micro-batch of many files each, landed once per event."""
    topic, out, checkpoint = (fresh_path(spark, name) for name in ("topic", "distinct", "checkpoint"))
    for part in parts:
        part.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(topic)
        decoded = decode_lines(file_messages(spark, topic), tables.EVENT_SCHEMA)
        timed = decoded.drop(RAW_LINE, PARTLY_READ).withColumn("at", F.to_timestamp("event_ts"))
        land_distinct(timed, "event_id", "at", delay, out, checkpoint).awaitTermination()
    return read_distinct(spark, out, timed.schema).drop("at")


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event sent twice, each kept once."""
    event = tables.event_documents(spark, sf_dir)
    return _distinct(spark, [event.unionByName(event), event], "60 DAYS").drop("kind")


@query
def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the events, then all of them: new ones beyond the delay land as late ones."""
    event = tables.event_documents(spark, sf_dir)
    return _distinct(spark, [event.where("event_id % 2 = 0"), event], "5 DAYS").select("event_id", "kind")


@query
def stream_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats whose event time is far later than the first one's, or whose first had none: the
    first arrival stays, in time or late as it came."""
    event = tables.event_documents(spark, sf_dir)
    untimed = event.withColumn("event_ts", F.when(F.col("event_id") % 3 != 0, F.col("event_ts")))
    later = (F.col("event_ts").cast("timestamp") + F.expr("INTERVAL 400 DAYS")).cast("string")
    again = event.withColumn("event_ts", F.when(F.col("event_id") % 2 == 0, later).otherwise(F.col("event_ts")))
    parts = [untimed.where("event_id % 2 = 0"), again, event]
    return _distinct(spark, parts, "5 DAYS").select("event_id", "kind", "event_ts")


@query
def stream_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams into one folder; what one of them left without an entry in the log is not read."""
    landed = fresh_path(spark, "landed")
    for part in (0, 1):
        topic = _topic_files(spark, tables.event_lines(spark, sf_dir, f"event_id % 2 = {part}"))
        decoded = decode_lines(file_messages(spark, topic), tables.EVENT_SCHEMA)
        land_stream(decoded, landed, fresh_path(spark, "checkpoint")).awaitTermination()
        if not part:
            (whole,) = committed(spark, landed)
    for entry in committed(spark, landed):
        if entry.place != whole.place:
            drop_commit(spark, landed, entry.place)
    return read_bronze(spark, landed, tables.EVENT_SCHEMA).select("event_id", RAW_LINE)


@query
def stream_admitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as messages, admitted 200 to a batch at most, with a restart half-way."""
    customer = tables.table(spark, sf_dir, "customer").orderBy("c_custkey")
    lines = customer.select(F.to_json(F.struct("c_custkey", "c_name", "c_nationkey")).alias("value"))
    topic, landed = _topic_files(spark, lines), fresh_path(spark, "landed")
    checkpoint, position = fresh_path(spark, "checkpoint"), fresh_path(spark, "position")
    schema = T.StructType.fromDDL("c_custkey BIGINT, c_name STRING, c_nationkey BIGINT")

    most = 200

    def run(wanted: int) -> None:
        messages = decode_lines(counted_messages(spark, topic, position, most=most), schema)
        query = land_stream(messages, landed, checkpoint, trigger={"processingTime": "0 seconds"})
        # No fewer batches hold as many, so the log is not read before the last of those is in it.
        last = f"stream={stream_id(spark, checkpoint)}/batch={-(-wanted // most) - 1}"
        while query.isActive and wanted and not (
            has_commit(spark, landed, last)
            and sum(entry.documents for entry in committed(spark, landed)) >= wanted
        ):
            query.awaitTermination(0.2)
        query.stop()

    every = customer.count()
    run(every // 2)
    run(every)
    batch = F.regexp_extract(F.col("_metadata.file_path"), r"/batch=(\d+)/", 1).cast("bigint")
    return read_landed(spark, landed, schema).select("*", batch.alias("batch"))


@query
def publish_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published in two batches, each user's in order of time, and landed: the place of
    each among its user's messages, by their numbers."""
    topic, source, checkpoint = (fresh_path(spark, name) for name in ("published", "source", "checkpoint"))
    event = tables.event_documents(spark, sf_dir)
    for part in (1, 0):
        lines = event.where(F.col("event_id") % 2 == part).select(F.to_json(F.struct("*")).alias("value"))
        lines.write.mode("append").text(source)
        documents, _ = split_corrupt(decode_lines(file_messages(spark, source), tables.EVENT_SCHEMA))
        position = [F.to_timestamp("event_ts"), F.col("event_id")]
        publish_in_order(documents, "user_id", position, to_files(topic), checkpoint).awaitTermination()
    landed, schema = fresh_path(spark, "landed"), T.StructType([*tables.EVENT_SCHEMA.fields]).add(SEQUENCE, T.LongType())
    decoded = decode_lines(file_messages(spark, f"{topic}/batch=*"), schema)
    land_stream(decoded, landed, fresh_path(spark, "checkpoint")).awaitTermination()
    place = F.row_number().over(Window.partitionBy("user_id").orderBy(SEQUENCE))
    return read_landed(spark, landed, schema).select("event_id", "user_id", place.alias("place"))


@query
def publish_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published as keyed messages, and landed from what was published."""
    event = tables.event_documents(spark, sf_dir)
    source = _topic_files(spark, event.select(F.to_json(F.struct("*")).alias("value")))
    documents, _ = split_corrupt(decode_lines(file_messages(spark, source), tables.EVENT_SCHEMA))
    topic, landed = fresh_path(spark, "published"), fresh_path(spark, "landed")
    messages = keyed_messages(documents, "user_id")
    publish_to_files(messages, topic, fresh_path(spark, "checkpoint")).awaitTermination()
    decoded = decode_lines(file_messages(spark, topic), tables.EVENT_SCHEMA)
    land_stream(decoded, landed, fresh_path(spark, "checkpoint")).awaitTermination()
    compacted = fresh_path(spark, "compacted")
    compact_landed(spark, landed, compacted, documents_per_file=1_000_000)
    return read_landed(spark, compacted, tables.EVENT_SCHEMA)


@query
def stream_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed documents republished as keyed messages."""
    lines = tables.event_documents(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))
    decoded = decode_lines(file_messages(spark, _topic_files(spark, lines)), tables.EVENT_SCHEMA)
    out = fresh_path(spark, "published")
    (
        keyed_messages(decoded.drop(RAW_LINE, PARTLY_READ), "user_id")
        .writeStream.format("parquet")
        .option("checkpointLocation", fresh_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start(out)
        .awaitTermination()
    )
    return spark.read.schema("key STRING, value STRING").parquet(out)


@query
def max_offsets_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages: the type is the topic, the hour the partition."""
    messages = tables.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"),
        F.hour("ts").alias("partition"),
        F.col("event_id").alias("offset"),
    )
    return max_offsets(messages)
