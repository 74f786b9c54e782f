"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from oracle_check import differences, open_tables

import __spark_entry__ as entry_file
from casewise.workload.catalog import QUERIES as WORKLOAD

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in entry_file.queries().items() if name in WORKLOAD}
ORACLE = {name: sql for name, sql in entry_file.oracle_sql().items() if name in WORKLOAD}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def connection():
    return open_tables(SF_DIR)


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_its_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SF_DIR), connection, ORACLE[name]) == []


def test_flagship(spark):
    result = entry_file.entry(spark)
    assert result.columns[:2] == ["active_substance", "reaction_term"]
    assert result.count() > 0
