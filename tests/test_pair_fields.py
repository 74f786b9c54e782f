"""Pairs need few fields of a document, so only those are made behind the version cut."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from casewise.operators.signals import PAIR_SCHEMA, pairs_from_documents
from casewise.operators.silver import latest_made
from casewise.schema import BRONZE_SCHEMA
from casewise.workload import tables


def _lines(spark):
    columns = (
        "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "ship STRING, order STRING, o_orderstatus STRING, o_orderpriority STRING, p_name STRING, "
        "p_brand STRING, p_type STRING, p_size INT, s_name STRING, n_name STRING"
    )
    row = (1, 1, 1, 1, 7.0, 10.0, 0.05, 0.02, "A", "O", "1995-01-02", "1995-01-01", "F", "1-URGENT",
           "pin", "Brand#1", "SMALL", 3, "maker", "CHAD")
    newer = (*row[:10], "1996-03-04", *row[11:14], "nail", "Brand#2", *row[16:])
    other = (2, *row[1:8], "R", "F", None, None, *row[12:])
    lines = spark.createDataFrame([row, newer, newer, other], columns)
    days = {to: F.col(of).cast("timestamp_ntz") for to, of in (("l_shipdate", "ship"), ("o_orderdate", "order"))}
    return lines.withColumns(days).drop("ship", "order")


def test_pairs_of_few_fields_are_those_of_whole_documents(spark):
    whole = latest_made(_lines(spark), tables._made)
    few = latest_made(_lines(spark), tables._made, partial(tables._made, schema=PAIR_SCHEMA))
    assert few.schema.names == PAIR_SCHEMA.names
    for suspect_only in (True, False):
        wanted, found = (
            sorted(tuple(row) for row in pairs_from_documents(latest, suspect_only).collect())
            for latest in (whole, few)
        )
        assert wanted == found
        assert ("1-1", "BRAND#2", "CHAD") in found
        assert not any("BRAND#1" in pair for pair in found if pair[0] == "1-1")


def test_a_day_as_text_is_that_of_the_pattern(spark):
    days = ["1995-01-02", "0999-12-31", "0001-01-01", "9999-12-31", "+10000-01-01", None]
    day = spark.createDataFrame([(d,) for d in days], "text STRING").selectExpr("cast(text AS DATE) AS day")
    text = day.selectExpr(f"{tables._compact('day')} AS found", "date_format(day, 'yyyyMMdd') AS wanted")
    rows = text.collect()
    assert [row.found for row in rows] == [row.wanted for row in rows]
    assert rows[0].found == "19950102"


def test_whole_documents_keep_every_field(spark):
    assert tables._made(_lines(spark)).schema.names == BRONZE_SCHEMA.names
