from __future__ import annotations

import datetime

import pytest
from builders import case
from pyspark.sql import functions as F

from casewise import functions as fn
from casewise.operators.assessors import case_text
from casewise.operators.assessment import VISIBLE, with_content_key
from casewise.schema import SEX_CODES


def evaluate(spark, expression, **columns):
    values = [
        F.lit(value).cast("string" if value is None else _kind(value)).alias(name)
        for name, value in columns.items()
    ]
    frame = spark.range(1).select(*values) if values else spark.range(1)
    return frame.select(expression.alias("x")).first()["x"]


def _kind(value):
    return {str: "string", float: "double", int: "int"}[type(value)]


@pytest.mark.parametrize(
    "code, label", [("1", "male"), ("2", "female"), ("99", None), ("", None), (None, None)]
)
def test_decode(spark, code, label):
    assert evaluate(spark, fn.decode(F.col("c"), SEX_CODES), c=code) == label


@pytest.mark.parametrize("code, flag", [("1", True), ("2", False), (None, None)])
def test_code_flag_is_three_valued(spark, code, flag):
    assert evaluate(spark, fn.code_flag(F.col("c")), c=code) is flag


@pytest.mark.parametrize(
    "value, fmt, day, precision",
    [
        ("20240110", "102", datetime.date(2024, 1, 10), "day"),
        ("202403", "610", datetime.date(2024, 3, 1), "month"),
        ("2024", "602", None, "unknown"),
        ("20240110", None, datetime.date(2024, 1, 10), "day"),
        ("202401", None, None, "unknown"),
        ("20240231", "102", None, "unknown"),
        ("202413", "610", None, "unknown"),
        ("2024-1-1", "102", None, "unknown"),
        ("garbage", "102", None, "unknown"),
        (None, "102", None, "unknown"),
        (None, None, None, "unknown"),
        ("20240110", "999", None, "unknown"),
    ],
)
def test_partial_dates(spark, value, fmt, day, precision):
    parsed = fn.parse_partial_date(F.col("v"), F.col("f"))
    assert evaluate(spark, parsed, v=value, f=fmt) == day
    assert evaluate(spark, fn.date_precision(F.col("v"), F.col("f")), v=value, f=fmt) == precision


def test_compact_date(spark):
    assert evaluate(spark, fn.compact_date(F.lit(datetime.date(2024, 3, 1)))) == "20240301"


@pytest.mark.parametrize(
    "raw, term",
    [("  dupilumab  ", "DUPILUMAB"), ("\t a b\r\n", "A B"), (" x　", "X"), ("   ", ""), (None, None)],
)
def test_normalize_term(spark, raw, term):
    assert evaluate(spark, fn.normalize_term(F.col("t")), t=raw) == term


@pytest.mark.parametrize("number", [45.0, 0.5, 7.25, 100.0, 33.333333, 999999.0, 1234567.0, 1e-5, 12e20, -3.0])
def test_format_general_is_six_significant_digits(spark, number):
    assert evaluate(spark, fn.format_general(F.col("n")), n=number) == f"{number:g}"


def test_array_helpers(spark):
    arrays = spark.sql(
        "SELECT array('a', 'b') AS two, cast(array() AS array<string>) AS none, "
        "cast(NULL AS array<string>) AS missing"
    )
    row = arrays.select(
        *(fn.first_element(F.col(c)).alias(f"first_{c}") for c in ("two", "none", "missing")),
        *(fn.safe_size(F.col(c)).alias(f"size_{c}") for c in ("two", "none", "missing")),
    ).first()
    assert tuple(row) == ("a", None, None, 2, 0, 0)


def test_estimate_cost_of_the_published_run(spark):
    cost = evaluate(spark, fn.estimate_cost(F.lit(43366), F.lit(6730)))
    assert round(cost, 3) == 0.077


def text_of(frame) -> str:
    return frame.select(case_text().alias("t")).first()["t"]


def test_render_full_case(cases_of):
    drugs = [
        {"active_substance": "X", "medicinal_product": "P", "drug_role": "suspect", "indication": "PAIN"},
        {"active_substance": None, "medicinal_product": "P", "drug_role": None, "indication": None},
        {"active_substance": None, "medicinal_product": "", "drug_role": "concomitant", "indication": ""},
    ]
    reactions = [
        {"reaction_term": "RASH", "reaction_outcome": "fatal"},
        {"reaction_term": "NAUSEA", "reaction_outcome": None},
    ]
    text = text_of(cases_of(case(drugs=drugs, reactions=reactions)))
    assert text.split("\n") == [
        "CASE",
        "",
        "Patient: age 45, female",
        "Country: US",
        "",
        "What happened:",
        "  - RASH (outcome: fatal)",
        "  - NAUSEA",
        "",
        "What was taken:",
        "  - X (suspect), indication: PAIN",
        "  - P (role not stated)",
        "  - product without a name (concomitant)",
        "",
        "Reply with one JSON object that holds your assessment of this case.",
    ]


@pytest.mark.parametrize("empty", [None, []])
def test_render_without_children_or_demographics(cases_of, empty):
    bare = case(patient_sex=None, patient_onset_age=0.0, occur_country=None, drugs=empty, reactions=empty)
    text = text_of(cases_of(bare))
    assert text.count("  - nothing listed") == 2
    assert "Patient" not in text and "Country" not in text


def test_label_never_reaches_the_text_or_the_key(cases_of):
    labelled, other = case(label_seriousness="serious"), case(label_seriousness="non_serious")
    assert "serious" not in text_of(cases_of(labelled))
    assert "label_seriousness" not in VISIBLE
    keys = with_content_key(cases_of(labelled, other), "m", "v1").select("content_key").distinct()
    assert keys.count() == 1


def test_content_key_depends_on_model_version_and_content(cases_of):
    def key(case_row, model, version):
        return with_content_key(cases_of(case_row), model, version).first()["content_key"]

    base = key(case(), "m", "v1")
    assert len(base) == 32
    assert len({base, key(case(), "n", "v1"), key(case(), "m", "v2"), key(case("R2"), "m", "v1")}) == 4
    assert base == key(case(), "m", "v1")


def test_null_and_absent_text_do_not_share_a_key(cases_of):
    null, empty = case(occur_country=None), case(occur_country="")
    assert with_content_key(cases_of(null, empty), "m", "v").select("content_key").distinct().count() == 2
