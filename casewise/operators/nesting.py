"""Cases: one nested row per report for the assessment step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewise.functions import decode, safe_size
from casewise.operators.silver import REPORT_KEY, drug_fields, reaction_fields
from casewise.schema import CASE_SCHEMA, SERIOUS_CODES, SEX_CODES

_DRUG_PARTS = ("active_substance", "medicinal_product", "drug_role", "indication")
_REACTION_PARTS = ("reaction_term", "reaction_outcome")


def _packed(array: Column, fields, parts: tuple[str, ...]) -> Column:
    kept = F.filter(array, lambda item: item.isNotNull())

    def pack(item: Column) -> Column:
        typed = fields(item)
        return F.struct(*(typed[part].alias(part) for part in parts))

    return F.when(safe_size(kept) > 0, F.transform(kept, pack))


def cases_from_documents(latest: DataFrame) -> DataFrame:
    """Cases straight from version-cut documents.

    Row-local: the children already sit in their report's row, so there is nothing
    to explode, group or join. A report without children has null arrays.
    """
    return latest.select(
        REPORT_KEY,
        decode(F.col("patient.patientsex"), SEX_CODES).alias("patient_sex"),
        F.col("patient.patientonsetage").try_cast("double").alias("patient_onset_age"),
        F.col("occurcountry").alias("occur_country"),
        _packed(F.col("patient.drug"), drug_fields, _DRUG_PARTS).alias("drugs"),
        _packed(F.col("patient.reaction"), reaction_fields, _REACTION_PARTS).alias("reactions"),
        decode(F.col("serious"), SERIOUS_CODES).alias("label_seriousness"),
    )


def _gathered(table: DataFrame, seq: str, parts: tuple[str, ...], name: str) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct(seq, *parts)))
    return table.groupBy(REPORT_KEY).agg(
        F.transform(ordered, lambda item: F.struct(*(item[p].alias(p) for p in parts))).alias(name)
    )


def cases_from_tables(
    report: DataFrame, drug: DataFrame, reaction: DataFrame, limit: int | None = None
) -> DataFrame:
    """Cases from the three stored tables, for when only those are at hand.

    A group here is one report's children. They came out of a single JSON document,
    which a reader task has already held as one row, so a group is bounded by that.
    With a limit, only the children of the chosen reports are grouped.
    """
    if limit:
        report = cap_cases(report, limit)
        chosen = report.select(REPORT_KEY)
        drug, reaction = (t.join(chosen, REPORT_KEY, "left_semi") for t in (drug, reaction))
    return (
        report.join(_gathered(drug, "drug_seq", _DRUG_PARTS, "drugs"), REPORT_KEY, "left")
        .join(_gathered(reaction, "reaction_seq", _REACTION_PARTS, "reactions"), REPORT_KEY, "left")
        .withColumn("label_seriousness", F.col("seriousness"))
        .select(*CASE_SCHEMA.fieldNames())
    )


def cap_cases(cases: DataFrame, limit: int | None = None) -> DataFrame:
    """The first ``limit`` cases by report id: the billing guard of a run that asks for one.

    Sort and limit together are a top-k: every task keeps its own first few.
    """
    return cases.orderBy(REPORT_KEY).limit(limit) if limit else cases
