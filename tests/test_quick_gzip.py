"""Quickly gzipped documents are the same documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewise.sources import read_bronze, write_ndjson
from casewise.schema import BRONZE_SCHEMA


def test_quick_files_are_larger_and_read_the_same(spark, tmp_path):
    key = F.sha2(F.col("id").cast("string"), 256)
    rows = spark.range(0, 3000, 1, 1).select(key.alias("safetyreportid"), F.lit("1").alias("serious"))
    sizes = {}
    for quick in (False, True):
        path = tmp_path / str(quick)
        write_ndjson(rows, str(path), compression="gzip", quick=quick)
        sizes[quick] = sum(part.stat().st_size for part in path.glob("part-*.gz"))
        scan = read_bronze(spark, str(path), BRONZE_SCHEMA)
        assert scan.select("safetyreportid", "serious").exceptAll(rows).isEmpty()
        assert scan.count() == 3000
    assert sizes[False] < sizes[True]
