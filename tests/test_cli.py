"""The jobs from the command line, one after another over the same folders."""

from __future__ import annotations

import json

from builders import drug, reaction, report, write_lines

from casewise.__main__ import main
from casewise.streaming import committed, read_landed


def run(capsys, *argv) -> dict:
    code = main([str(arg) for arg in argv])
    return {"code": code, **json.loads(capsys.readouterr().out)}


def test_jobs(spark, tmp_path, capsys):
    rows = [report(f"R{i}", drugs=[drug("A")], reactions=[reaction("X")]) for i in range(4)]
    write_lines(tmp_path / "in" / "a.json", rows)
    bronze, silver, gold = tmp_path / "root/bronze/drug_event", tmp_path / "silver", tmp_path / "gold"

    days = ("--start", "2024-01-01", "--end", "2024-01-31")
    landed = run(capsys, "land", "--source", tmp_path / "in", "--root", tmp_path / "root", *days)
    assert (landed["code"], landed["record_count"], landed["window_count"]) == (0, 4, 5)

    write_lines(tmp_path / "topic" / "a.json", [report("R9")])
    places = ("--out", tmp_path / "stream", "--checkpoint", tmp_path / "cp")
    streamed = run(capsys, "stream", "--source", tmp_path / "topic", *places)
    assert (streamed["batches"], streamed["records"]) == (1, 1)

    places = ("--silver", silver, "--gold", gold)
    stats = run(capsys, "transform", "--bronze", bronze, tmp_path / "stream", *places)
    assert (stats["bronze_rows"], stats["silver_report_rows"]) == (5, 5)

    metrics = run(capsys, "enrich", "--cases", silver / "enrichment_input", "--gold", gold, "--limit", 3)
    assert (metrics["attempted"], metrics["enriched"]) == (3, 3)
    assert (metrics["available"], metrics["withheld"]) == (5, 2)

    scores = run(capsys, "evaluate", "--assessments", gold / "assessments", "--out", gold / "_eval")
    assert (scores["code"], scores["n_scored"]) == (0, 3)


def test_publish_and_a_running_stream(spark, tmp_path, capsys):
    for i in range(3):
        write_lines(tmp_path / "in" / f"{i}.json", [report(f"R{i}")])
    topic = ("--source", tmp_path / "in", "--topic", tmp_path / "topic", "--checkpoint", tmp_path / "cp-p")
    published = run(capsys, "publish", *topic, "--rate", 50, "--records-per-file", 1, "--files-per-batch", 1, "--idle", 3)
    assert (published["batches"], published["records"]) == (3, 3)

    stream = ("--source", tmp_path / "topic", "--out", tmp_path / "out", "--checkpoint", tmp_path / "cp")
    running = ("--interval", 0.1, "--files-per-batch", 1, "--ingest-date", "2024-05-01")
    first = run(capsys, "stream", *stream, *running, "--max-batches", 1)
    rest = run(capsys, "stream", *stream, *running, "--idle", 3)
    assert first["records"] >= 1 and first["records"] + rest["records"] == 3
    assert len(list(tmp_path.glob("out/documents/*/*/ingest_date=2024-05-01/part-*"))) == 3


def test_landing_accounts_for_broken_lines(spark, tmp_path, capsys):
    write_lines(tmp_path / "in" / "a.json", [report("R1"), "{torn", report("R2", receivedate=None)])
    days = ("--start", "2024-01-01", "--end", "2024-01-31")
    landed = run(capsys, "land", "--source", tmp_path / "in", "--root", tmp_path / "root", *days)
    assert [landed[n] for n in ("rows_in", "record_count", "broken_count", "undated_count")] == [3, 1, 1, 1]


def test_no_input(spark, tmp_path, capsys):
    write_lines(tmp_path / "cases" / "a.json", [""])
    result = run(capsys, "enrich", "--cases", tmp_path / "cases", "--gold", tmp_path / "gold")
    assert (result["code"], result["status"]) == (1, "no_input")


def test_ordered_publish_and_counted_landing(spark, tmp_path, capsys):
    rows = [report(f"R{i % 3}", receiptdate=f"202401{10 + i}") for i in range(9)]
    write_lines(tmp_path / "in" / "a.json", rows[::-1])
    topic, out = tmp_path / "topic", tmp_path / "out"
    run(capsys, "publish", "--source", tmp_path / "in", "--topic", topic, "--checkpoint", tmp_path / "cp-p", "--order-by", "receiptdate")
    (folder,) = topic.glob("batch=*")
    lines = [json.loads(line) for part in folder.glob("part-*") for line in part.read_text().splitlines()]
    for key in ("R0", "R1", "R2"):
        mine = [line for line in lines if line["safetyreportid"] == key]
        assert [line["receiptdate"] for line in mine] == sorted(line["receiptdate"] for line in mine)
        assert [line["sequence"] for line in mine] == [1, 2, 3]
    places = ("--source", folder, "--out", out, "--checkpoint", tmp_path / "cp", "--interval", 0.1)
    landed = run(capsys, "stream", *places, "--most-records", 4, "--least-records", 1, "--max-seconds", 0, "--idle", 15)
    assert (landed["code"], landed["records"]) == (0, 9)
    sizes = [entry.documents for entry in committed(spark, str(out))]
    assert sum(sizes) == 9 and max(sizes) == 4
    assert read_landed(spark, str(out)).count() == 9
