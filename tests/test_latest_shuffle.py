"""The newest versions of the given tables are cut where the join with the orders left the lines."""

from __future__ import annotations

from datetime import datetime

import pytest

from casewise.operators.signals import pairs_from_documents
from casewise.operators.silver import latest_versions
from casewise.workload import tables
from casewise.workload.catalog import QUERIES

DAY = datetime(2024, 3, 5)


@pytest.fixture
def folder(spark, tmp_path):
    """Repeated orders and lines, lines without a number or an order, keys that differ in their sign."""
    line = [
        (key, part, 1, number, 5.0 * part, 10.0 * part, 0.05, 0.02, "A", "O", DAY)
        for key in (1, 2, -2, 12, None)
        for number in (1, 2, None)
        for part in (1, 2)
    ]
    rows = {
        "lineitem": [*line, *line[:3]],
        "orders": [(key, "F", DAY, "1-URGENT") for key in (1, 1, 2, -2, 12, None)],
        "part": [(1, "one", "B1", "T1", 3), (2, "two", "B2", "T2", 30)],
        "supplier": [(1, "S", 7)],
        "nation": [(7, "N")],
    }
    for name, some in rows.items():
        table = spark.createDataFrame(some, tables._SCHEMAS[name])
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_the_newest_ones_are_those_of_all_documents(spark, folder):
    kept = tables.latest(spark, folder)
    wanted = latest_versions(tables.documents(spark, folder))
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, wanted.collect()))
    assert kept.count() == 12


def test_lines_are_dealt_out_by_order_only(spark, folder):
    plan = tables.latest(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey" in plan
    assert plan.count("Exchange hashpartitioning(") == 2  # the lines and the orders


def test_pairs_from_tables_are_those_of_all_documents(spark, folder):
    """``pair_build`` as a whole, its work table included, against the pairs from the documents."""
    pairs = QUERIES["pair_build"](spark, folder)
    wanted = pairs_from_documents(latest_versions(tables.documents(spark, folder)))
    assert sorted(map(repr, pairs.collect())) == sorted(map(repr, wanted.collect()))
    assert pairs.count() > 0
