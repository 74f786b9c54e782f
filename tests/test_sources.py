from __future__ import annotations

import gzip
import json
import time

import pytest
from builders import enriched, report, write_lines

from casewise.schema import BRONZE_SCHEMA, CASE_SCHEMA, ENRICHED_SCHEMA, TRANSFORM_SCHEMA
from casewise.sources import (
    decode_lines,
    lost_lines,
    materialize,
    newest_assessments,
    read_assessments,
    read_bronze,
    read_ndjson,
    read_silver,
    shared_root,
    split_corrupt,
    union_bronze,
    write_ndjson,
    write_partitioned_ndjson,
    write_summary,
    write_table,
)


def test_schemas_need_no_session():
    assert BRONZE_SCHEMA.fieldNames()[0] == "safetyreportid"
    assert len(BRONZE_SCHEMA["patient"].dataType["drug"].dataType.elementType) == 10


def test_the_transform_reads_what_it_uses():
    drug = TRANSFORM_SCHEMA["patient"].dataType["drug"].dataType.elementType
    assert len(drug) == 9 and drug["openfda"].dataType.fieldNames() == ["generic_name", "manufacturer_name"]
    assert TRANSFORM_SCHEMA["primarysource"].dataType.fieldNames() == ["reportercountry"]
    assert TRANSFORM_SCHEMA.fieldNames() == BRONZE_SCHEMA.fieldNames()


def test_unknown_and_missing_fields(spark, tmp_path):
    path = write_lines(tmp_path / "a.json", [{**report(), "surprise": 1}, {"safetyreportid": "R2"}])
    documents, broken = split_corrupt(read_bronze(spark, path))
    assert documents.columns == BRONZE_SCHEMA.fieldNames()
    assert documents.count() == 2 and broken.count() == 0


def test_broken_lines_are_kept_apart(spark, tmp_path):
    lines = [report(), '{"safetyreportid": "R9"', "not json", "", "   "]
    documents, broken = split_corrupt(read_bronze(spark, write_lines(tmp_path / "a.json", lines)))
    assert [r.safetyreportid for r in documents.collect()] == ["R1"]
    assert sorted(r.raw_line for r in broken.collect()) == ["not json", '{"safetyreportid": "R9"']


def test_a_field_of_the_wrong_type_is_null_and_the_rest_is_kept(spark, tmp_path):
    path = write_lines(tmp_path / "a.json", [{**report(), "patient": "none"}])
    documents, broken = split_corrupt(read_bronze(spark, path))
    row = documents.first()
    assert (row.safetyreportid, row.patient) == ("R1", None)
    assert broken.count() == 0
    (line,) = lost_lines(read_bronze(spark, path)).collect()
    assert json.loads(line.raw_line)["patient"] == "none"


@pytest.mark.parametrize("line", ['{"safetyreportid": "R9"', "torn"])
def test_a_torn_line_fails_a_strict_read(spark, tmp_path, line):
    path = write_lines(tmp_path / "a.json", [{"safetyreportid": "R1"}, line])
    frame = read_ndjson(spark, path, CASE_SCHEMA)
    for action in (frame.collect, frame.count, frame.select("drugs").collect):
        with pytest.raises(Exception, match="unreadable line"):
            action()


def test_a_wrong_type_fails_a_strict_read(spark, tmp_path):
    path = write_lines(tmp_path / "a.json", [{"safetyreportid": "R1", "drugs": "none"}])
    with pytest.raises(Exception, match="unreadable line"):
        read_ndjson(spark, path, CASE_SCHEMA).collect()


def test_a_torn_assessment_fails_the_read(spark, tmp_path):
    with gzip.open(tmp_path / "a.json.gz", "wt") as out:
        out.write('{"safetyreportid": "R1"')
    with pytest.raises(Exception, match="unreadable line"):
        read_assessments(spark, str(tmp_path)).collect()


def test_batch_and_stream_decoding_agree(spark, tmp_path):
    lines = [report("R1"), "broken", {**report("R2"), "patient": 5}, "", {"other": 1}]
    path = write_lines(tmp_path / "a.json", lines)
    batch = read_bronze(spark, path)
    decoded = decode_lines(spark.read.text(path))
    assert batch.columns == decoded.columns
    assert sorted(map(repr, batch.collect())) == sorted(map(repr, decoded.collect()))


def test_folder_layout_adds_no_column(spark, tmp_path):
    write_lines(tmp_path / "ingest_date=2024-01-01" / "a.json", [report("R1")])
    write_lines(tmp_path / "ingest_date=2024-01-02" / "b.json", [report("R2")])
    whole = read_bronze(spark, str(tmp_path))
    by_glob = read_bronze(spark, f"{tmp_path}/*/*.json")
    assert whole.columns == by_glob.columns
    assert whole.count() == by_glob.count() == 2


def test_several_paths(spark, tmp_path):
    paths = [write_lines(tmp_path / f"{i}" / "a.json", [report(f"R{i}")]) for i in range(2)]
    assert read_bronze(spark, paths).count() == 2


def test_ndjson_folder_with_marker_gzip_and_blank_lines(spark, tmp_path):
    write_lines(tmp_path / "a.json", [{"safetyreportid": "R1"}, "", {"safetyreportid": "R2"}])
    (tmp_path / "_SUCCESS").write_text("")
    with gzip.open(tmp_path / "b.json.gz", "wt") as out:
        out.write(json.dumps({"safetyreportid": "R3"}) + "\n")
    rows = read_ndjson(spark, str(tmp_path), CASE_SCHEMA).collect()
    assert sorted(r.safetyreportid for r in rows) == ["R1", "R2", "R3"]


def test_assessments_at_any_depth(spark, enriched_of, tmp_path):
    place = {"ingest_date": "2024-01-01", "run_id": "a"}
    write_partitioned_ndjson(enriched_of(enriched("R1", substances=["X"])), str(tmp_path), place)
    write_lines(tmp_path / "note.json", [{"safetyreportid": "not this"}])
    frame = read_assessments(spark, str(tmp_path))
    assert frame.schema == ENRICHED_SCHEMA
    assert [(r.safetyreportid, r.assessment.seriousness) for r in frame.collect()] == [("R1", "serious")]


def test_a_partitioned_write_replaces_only_its_partition(spark, tmp_path):
    path = str(tmp_path / "out")
    for day, keys in (("2024-01-01", "ab"), ("2024-01-02", "c"), ("2024-01-01", "z")):
        frame = spark.createDataFrame([(k,) for k in keys], "k STRING")
        write_partitioned_ndjson(frame, path, {"ingest_date": day})
    stored = spark.read.json(path)
    assert sorted((r.k, str(r.ingest_date)) for r in stored.collect()) == [("c", "2024-01-02"), ("z", "2024-01-01")]


def test_null_fields_of_a_summary_are_written(spark, tmp_path):
    write_summary(spark.sql("SELECT 1 AS a, cast(NULL AS string) AS error"), str(tmp_path / "s"))
    (line,) = spark.read.text(str(tmp_path / "s")).collect()
    assert json.loads(line.value) == {"a": 1, "error": None}


def test_ndjson_write_keeps_its_tasks(spark, tmp_path):
    write_ndjson(spark.range(100).repartition(3), str(tmp_path / "n"))
    assert len(list((tmp_path / "n").glob("part-*"))) == 3


def test_silver_round_trip(spark, tmp_path):
    for name in ("report", "drug", "reaction"):
        write_table(spark.createDataFrame([(name,)], "kind STRING"), f"{tmp_path}/{name}")
    assert [t.first().kind for t in read_silver(spark, str(tmp_path))] == ["report", "drug", "reaction"]


def test_union(spark, bronze):
    stream = bronze(report("R2")).drop("duplicate")
    both = union_bronze(bronze(report("R1", duplicate="1")), stream)
    assert {r.safetyreportid: r.duplicate for r in both.collect()} == {"R1": "1", "R2": None}


def test_materialize_cuts_lineage(spark):
    frame = spark.range(5).selectExpr("id", "id * 2 AS twice")
    stored = materialize(frame, "t")
    assert stored.dtypes == frame.dtypes and stored.count() == 5
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "parquet" in plan.lower()


def test_work_folder_is_the_configured_one(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


class _Cluster:
    """A session as the work folder sees it: no folder configured, not local."""

    class sparkContext:
        master = "spark://host:7077"

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(_Cluster)


def test_the_newest_assessment_of_a_report(spark, enriched_of, tmp_path):
    """Two runs over one case: the later one counts."""
    for run, said in (("z", "serious"), ("a", "non_serious")):
        place = {"ingest_date": "2024-01-01", "run_id": run}
        write_partitioned_ndjson(enriched_of(enriched("R1", predicted=said), enriched(run)), str(tmp_path), place)
        time.sleep(1.1)
    rows = {r.safetyreportid: r.assessment.seriousness for r in newest_assessments(spark, str(tmp_path)).collect()}
    assert rows["R1"] == "non_serious" and set(rows) == {"R1", "a", "z"}
    assert read_assessments(spark, str(tmp_path)).count() == 4


def test_documents_written_as_lines_are_zipped(spark, tmp_path):
    from casewise.workload.catalog import _write_zipped

    path = str(tmp_path / "lines")
    _write_zipped(spark.range(5).selectExpr("to_json(named_struct('safetyreportid', cast(id AS STRING))) AS value"), path)
    assert all(file.suffix == ".gz" for file in (tmp_path / "lines").glob("part-*"))
    assert read_bronze(spark, path).where("safetyreportid IS NOT NULL").count() == 5
