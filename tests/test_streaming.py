from __future__ import annotations

import datetime
import json
import os
import time

import numpy as np
import pyarrow as pa
import pytest
from builders import report, write_lines
from pyspark.sql import functions as F

from casewise.operators.gates import GateFailed
from casewise.operators.silver import latest_versions, report_table
from casewise.plans.transform import run_transform
from casewise.schema import BRONZE_SCHEMA
from casewise.sources import decode_lines, read_bronze, split_corrupt, union_bronze
from casewise.sources.commits import drop_commit
from casewise.streaming import (
    BROKEN,
    IN_TIME,
    LATE,
    SEQUENCE,
    admission,
    arrivals,
    batch_options,
    committed,
    compact_landed,
    counted_messages,
    file_messages,
    ingest,
    keyed_messages,
    land_distinct,
    land_stream,
    max_offsets,
    publish_in_order,
    publish_to_files,
    read_distinct,
    read_landed,
    replay_trigger,
    to_files,
)


def stream_once(spark, source, out, checkpoint, **options):
    messages = file_messages(spark, str(source), options.pop("files_per_batch", None))
    query = land_stream(decode_lines(messages), str(out), str(checkpoint), **options)
    query.awaitTermination()
    return query


def keys(frame):
    return sorted(r.safetyreportid for r in frame.collect())


def test_batch_by_count_or_age():
    assert batch_options() == {"minOffsetsPerTrigger": "200", "maxTriggerDelay": "10s"}
    assert batch_options(3, 1, 9) == {
        "minOffsetsPerTrigger": "3",
        "maxTriggerDelay": "1s",
        "maxOffsetsPerTrigger": "9",
    }


def test_replay_rate():
    assert replay_trigger(500) == {"processingTime": "10000 milliseconds"}
    assert replay_trigger(100, 2, 200.0) == {"processingTime": "1000 milliseconds"}


def test_replay_stops_at_its_limit(spark, tmp_path):
    write_lines(tmp_path / "topic" / "a.json", [report(f"R{i}") for i in range(9)])
    messages = file_messages(spark, str(tmp_path / "topic"), limit=4)
    land_stream(decode_lines(messages), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert read_landed(spark, str(tmp_path / "out")).count() == 4


def test_a_timed_replay_can_be_stopped_and_resumed(spark, tmp_path):
    for i in range(2):
        write_lines(tmp_path / "topic" / f"{i}.json", [report(f"R{i}")])
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    messages = file_messages(spark, str(tmp_path / "topic"), files_per_batch=1)
    query = land_stream(decode_lines(messages), out, checkpoint, trigger=replay_trigger(1, 1, 20.0))
    query.processAllAvailable()
    query.stop()
    write_lines(tmp_path / "topic" / "2.json", [report("R2")])
    stream_once(spark, tmp_path / "topic", out, checkpoint)
    assert keys(read_landed(spark, out)) == ["R0", "R1", "R2"]


def test_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "topic"
    write_lines(source / "a.json", [report(f"R{i}") for i in range(3)] + ["poison", ""])
    stream_once(spark, source, tmp_path / "out", tmp_path / "cp")
    documents, broken = split_corrupt(read_bronze(spark, str(source)))
    landed = read_landed(spark, str(tmp_path / "out"))
    assert landed.schema == documents.schema
    whole = read_bronze(spark, str(tmp_path / "out"))
    assert whole.where("raw_line IS NOT NULL").count() == 1 and whole.count() == 4
    assert sorted(map(repr, landed.collect())) == sorted(map(repr, documents.collect()))
    poison = read_landed(spark, str(tmp_path / "out"), kind=BROKEN)
    assert [r.raw_line for r in poison.collect()] == [r.raw_line for r in broken.collect()] == ["poison"]


def test_a_broken_message_does_not_stop_the_stream(spark, tmp_path):
    write_lines(tmp_path / "topic" / "a.json", ["{", report("R1"), "5", report("R2")])
    stream_once(spark, tmp_path / "topic", tmp_path / "out", tmp_path / "cp")
    assert keys(read_landed(spark, str(tmp_path / "out"))) == ["R1", "R2"]


def test_layout_and_one_folder_per_batch(spark, tmp_path):
    for i in range(3):
        write_lines(tmp_path / "topic" / f"{i}.json", [report(f"R{i}")])
    day = F.lit("2024-05-01")
    stream_once(spark, tmp_path / "topic", tmp_path / "out", tmp_path / "cp", ingest_date=day, files_per_batch=1)
    folders = sorted(p.name for p in tmp_path.glob("out/documents/stream=*/batch=*"))
    assert folders == ["batch=0", "batch=1", "batch=2"]
    parts = list(tmp_path.glob("out/documents/*/*/ingest_date=2024-05-01/part-*"))
    assert len(parts) == 3 and all(p.name.endswith(".json.gz") for p in parts)


def test_default_date_is_that_of_the_batch(spark, tmp_path):
    write_lines(tmp_path / "topic" / "a.json", [report()])
    stream_once(spark, tmp_path / "topic", tmp_path / "out", tmp_path / "cp")
    (folder,) = tmp_path.glob("out/documents/*/*/ingest_date=*")
    day = datetime.date.fromisoformat(folder.name.removeprefix("ingest_date="))
    assert abs((datetime.datetime.now(datetime.UTC).date() - day).days) <= 1


def test_a_second_run_takes_up_where_the_first_stopped(spark, tmp_path):
    source = tmp_path / "topic"
    write_lines(source / "a.json", [report("R1")])
    stream_once(spark, source, tmp_path / "out", tmp_path / "cp")
    write_lines(source / "b.json", [report("R2")])
    stream_once(spark, source, tmp_path / "out", tmp_path / "cp")
    assert keys(read_landed(spark, str(tmp_path / "out"))) == ["R1", "R2"]


def test_a_failed_write_commits_nothing_and_a_rerun_delivers(spark, tmp_path):
    source, out, checkpoint = tmp_path / "topic", tmp_path / "out", tmp_path / "cp"
    write_lines(source / "a.json", [report("R1")])
    failing = F.when(F.col("safetyreportid") == "R1", F.expr("raise_error('store down')")).otherwise(F.lit("x"))
    with pytest.raises(Exception, match="store down"):
        stream_once(spark, source, out, checkpoint, ingest_date=failing)
    assert not list((checkpoint / "commits").glob("[0-9]*"))
    stream_once(spark, source, out, checkpoint)
    assert keys(read_landed(spark, str(out))) == ["R1"]


def test_a_batch_run_twice_lands_once(spark, tmp_path):
    """A crash between write and commit: the same batch is written again."""
    source, out, checkpoint = tmp_path / "topic", tmp_path / "out", tmp_path / "cp"
    write_lines(source / "a.json", [report("R1"), report("R2")])
    day = F.lit("2024-05-01")
    stream_once(spark, source, out, checkpoint, ingest_date=day)
    for entry in (checkpoint / "commits").iterdir():
        entry.unlink()
    stream_once(spark, source, out, checkpoint, ingest_date=day)
    assert keys(read_landed(spark, str(out))) == ["R1", "R2"]


def test_replayed_messages_collapse_downstream(spark, tmp_path):
    rows = [report("R1"), report("R1"), report("R2", receiptdate="20240110"), report("R2", receiptdate="20240220")]
    write_lines(tmp_path / "topic" / "a.json", rows)
    write_lines(tmp_path / "batch" / "a.json", rows[:1])
    stream_once(spark, tmp_path / "topic", tmp_path / "out", tmp_path / "cp")
    batch, _ = split_corrupt(read_bronze(spark, str(tmp_path / "batch")))
    both = union_bronze(batch, read_landed(spark, str(tmp_path / "out")))
    newest = {r.safetyreportid: r.receipt_date for r in report_table(latest_versions(both)).collect()}
    assert newest == {"R1": datetime.date(2024, 1, 10), "R2": datetime.date(2024, 2, 20)}


def test_nothing_to_replay_is_an_error(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        file_messages(spark, str(tmp_path / "empty"))


def test_keys(spark, bronze):
    rows = keyed_messages(bronze(report("12345"), report(None))).collect()
    by_key = {r.key: json.loads(r.value) for r in rows}
    assert set(by_key) == {"12345", None}
    assert by_key["12345"]["patient"]["drug"][0]["drugcharacterization"] == "1"


def test_keyed_messages_decode_back(spark, bronze):
    original = bronze(report("R1"), report("R2", drugs=[]))
    decoded, broken = split_corrupt(decode_lines(keyed_messages(original)))
    assert decoded.schema.simpleString() == BRONZE_SCHEMA.simpleString()
    assert sorted(map(repr, decoded.collect())) == sorted(map(repr, original.collect()))
    assert broken.count() == 0


def test_max_offsets(spark):
    rows = [("t", 0, 5), ("t", 0, 9), ("t", 1, 2), ("t", 1, 7), ("u", 0, 1)]
    frame = spark.createDataFrame(rows, "topic STRING, partition INT, offset BIGINT")
    assert {tuple(r) for r in max_offsets(frame).collect()} == {("t", 0, 9), ("t", 1, 7), ("u", 0, 1)}


def test_streams_into_one_folder_do_not_meet(spark, tmp_path):
    """Another source, and the same source with a new checkpoint."""
    write_lines(tmp_path / "a" / "a.json", [report("R1")])
    write_lines(tmp_path / "b" / "b.json", [report("R2")])
    stream_once(spark, tmp_path / "a", tmp_path / "out", tmp_path / "cp-a")
    stream_once(spark, tmp_path / "b", tmp_path / "out", tmp_path / "cp-b")
    assert keys(read_landed(spark, str(tmp_path / "out"))) == ["R1", "R2"]
    stream_once(spark, tmp_path / "a", tmp_path / "out", tmp_path / "cp-new")
    assert keys(read_landed(spark, str(tmp_path / "out"))) == ["R1", "R1", "R2"]


def test_a_batch_run_again_on_another_day_lands_once(spark, tmp_path):
    source, out, checkpoint = tmp_path / "topic", tmp_path / "out", tmp_path / "cp"
    write_lines(source / "a.json", [report("R1")])
    stream_once(spark, source, out, checkpoint, ingest_date=F.lit("2024-05-01"))
    for entry in (checkpoint / "commits").iterdir():
        entry.unlink()
    stream_once(spark, source, out, checkpoint, ingest_date=F.lit("2024-05-02"))
    assert keys(read_landed(spark, str(out))) == ["R1"]


def test_partly_read_messages_are_kept_as_they_are(spark, tmp_path):
    write_lines(tmp_path / "topic" / "a.json", [report("R1"), {"safetyreportid": "R2", "patient": "oops"}])
    stream_once(spark, tmp_path / "topic", tmp_path / "out", tmp_path / "cp")
    assert keys(read_landed(spark, str(tmp_path / "out"))) == ["R1"]
    (line,) = read_landed(spark, str(tmp_path / "out"), kind=BROKEN).collect()
    assert json.loads(line.raw_line)["patient"] == "oops"


def test_a_landed_folder_with_torn_messages_can_be_transformed(spark, tmp_path):
    write_lines(tmp_path / "topic" / "a.json", [report("R1"), report("R2"), "{torn"])
    stream_once(spark, tmp_path / "topic", tmp_path / "out", tmp_path / "cp")
    places = (str(tmp_path / "silver"), str(tmp_path / "gold"))
    with pytest.raises(GateFailed, match="corrupt_rate"):
        run_transform(spark, str(tmp_path / "out"), *places)
    assert run_transform(spark, str(tmp_path / "out"), *places, max_corrupt_rate=0.5)["bronze_rows"] == 3
    assert run_transform(spark, str(tmp_path / "out" / "documents"), *places)["bronze_rows"] == 2


def test_compaction_keeps_every_line(spark, tmp_path):
    for i in range(3):
        write_lines(tmp_path / "topic" / f"{i}.json", [report(f"R{i}"), "{torn"])
    stream_once(spark, tmp_path / "topic", tmp_path / "out", tmp_path / "cp", files_per_batch=1)
    compact_landed(spark, str(tmp_path / "out"), str(tmp_path / "small"), 100)
    assert keys(read_landed(spark, str(tmp_path / "small"))) == ["R0", "R1", "R2"]
    assert read_landed(spark, str(tmp_path / "small"), kind=BROKEN).count() == 3
    assert len(list(tmp_path.glob("small/documents/compacted/part-*"))) == 1


def _distinct(spark, tmp_path, batches, delay="1 HOUR"):
    """Every entry of ``batches`` is one micro-batch of (key, time) rows."""
    for i, rows in enumerate(batches):
        lines = [{"safetyreportid": k, "receiptdate": t} for k, t in rows]
        path = write_lines(tmp_path / "topic" / f"{i}.json", lines)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    decoded = decode_lines(file_messages(spark, str(tmp_path / "topic"), files_per_batch=1))
    timed = decoded.select("safetyreportid", F.to_timestamp("receiptdate").alias("at"))
    out, checkpoint = str(tmp_path / "kept"), str(tmp_path / "cp")
    land_distinct(timed, "safetyreportid", "at", delay, out, checkpoint).awaitTermination()
    found = read_distinct(spark, out, timed.schema).collect()
    return sorted((r.kind, r.safetyreportid or "-") for r in found)


def test_repeats_are_dropped_and_late_first_arrivals_are_not(spark, tmp_path):
    batches = [
        [("A", "2024-01-01 10:00:00"), ("A", "2024-01-01 10:05:00"), ("B", "2024-01-01 10:01:00")],
        [("A", "2024-01-01 10:06:00"), ("C", "2024-01-01 02:00:00"), ("D", "2024-01-01 09:30:00")],
        [("C", "2024-01-01 02:00:00"), ("B", "2023-12-01 00:00:00"), ("E", None)],
    ]
    expected = [(IN_TIME, k) for k in "ABD"] + [(LATE, k) for k in "CE"]
    assert _distinct(spark, tmp_path, batches) == expected


def test_rows_without_a_key_are_kept(spark, tmp_path):
    rows = [(None, "2024-01-01 10:00:00")] * 2
    assert _distinct(spark, tmp_path, [rows, rows]) == [(IN_TIME, "-")] * 4


def test_a_distinct_batch_run_again_changes_nothing(spark, tmp_path):
    batches = [[("A", "2024-01-01 10:00:00")], [("B", "2024-01-01 10:00:00")]]
    first = _distinct(spark, tmp_path, batches)
    for entry in (tmp_path / "cp" / "commits").glob("*1*"):
        entry.unlink()
    assert _distinct(spark, tmp_path, batches) == first == [(IN_TIME, "A"), (IN_TIME, "B")]


def test_published_messages_come_back(spark, tmp_path):
    write_lines(tmp_path / "in" / "a.json", [report("R1"), report("R2")])
    documents, _ = split_corrupt(decode_lines(file_messages(spark, str(tmp_path / "in"))))
    topic = str(tmp_path / "topic")
    publish_to_files(keyed_messages(documents), topic, str(tmp_path / "cp-p")).awaitTermination()
    stream_once(spark, topic, tmp_path / "out", tmp_path / "cp")
    landed = read_landed(spark, str(tmp_path / "out"))
    original, _ = split_corrupt(read_bronze(spark, str(tmp_path / "in")))
    assert sorted(map(repr, landed.collect())) == sorted(map(repr, original.collect()))


# --- whole batches only -----------------------------------------------------------


@pytest.mark.parametrize("stops_at", ["lost_lines", "commit_batch"])
def test_a_batch_is_seen_with_all_of_its_outputs_or_not_at_all(spark, tmp_path, monkeypatch, stops_at):
    """A run that ends between its writes, and one that ends before it has said so."""
    source, out, checkpoint = tmp_path / "topic", tmp_path / "out", tmp_path / "cp"
    write_lines(source / "a.json", [report("R1")])
    stream_once(spark, source, out, checkpoint)
    write_lines(source / "b.json", [report("R2"), "{torn"])

    def stop(*_, **__):
        raise OSError("lost here")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, stops_at, stop)
        with pytest.raises(Exception, match="lost here"):
            stream_once(spark, source, out, checkpoint)
    assert list(out.glob("documents/*/batch=1/*/part-*"))  # half of it is there
    assert keys(read_landed(spark, str(out))) == ["R1"]
    assert read_landed(spark, str(out), kind=BROKEN).count() == 0
    assert read_bronze(spark, str(out)).count() == 1
    stream_once(spark, source, out, checkpoint)
    assert keys(read_landed(spark, str(out))) == ["R1", "R2"]
    assert read_bronze(spark, str(out)).count() == 3


def test_a_folder_in_which_nothing_was_committed_is_empty(spark, tmp_path):
    write_lines(tmp_path / "topic" / "a.json", [report("R1")])
    stream_once(spark, tmp_path / "topic", tmp_path / "out", tmp_path / "cp")
    (entry,) = committed(spark, str(tmp_path / "out"))
    assert (entry.batch, entry.documents, entry.broken) == (0, 1, 0)
    drop_commit(spark, str(tmp_path / "out"), entry.place)
    assert read_landed(spark, str(tmp_path / "out")).count() == 0
    assert committed(spark, str(tmp_path / "never")) == []


# --- first arrivals ---------------------------------------------------------------


def test_a_repeat_is_one_whatever_its_time(spark, tmp_path):
    """Far later than the first arrival, far earlier, without a time, or the first had none."""
    batches = [
        [("A", "2024-01-01 10:00:00"), ("B", None), ("C", "2024-01-01 10:00:00"), ("D", "2024-01-01 10:00:00")],
        [("A", "2025-06-01 00:00:00"), ("B", "2024-01-01 10:00:00"), ("C", "1999-01-01 00:00:00"), ("D", None)],
        [("A", "2025-06-02 00:00:00"), ("E", "2024-01-01 10:00:00")],
    ]
    # The repeat of A in the future has not landed, so it does not make E late.
    assert _distinct(spark, tmp_path, batches) == [(IN_TIME, k) for k in "ACDE"] + [(LATE, "B")]


def test_the_first_of_a_batch_is_the_same_however_it_is_cut(spark):
    """Earliest time first, then none; ties by content; arrow batches of any size."""
    firsts = arrivals._firsts("key", "at")
    rows = [("a", 5, 1), ("b", None, 2), ("a", 3, 9), ("a", 3, 4), ("b", 7, 3), ("c", None, 5), ("c", None, 1)]
    names = ["key", "at", "_content"]
    for size in range(1, 8):
        table = pa.table({name: pa.array([row[i] for row in rows]) for i, name in enumerate(names)})
        kept = pa.Table.from_batches(firsts(iter(table.to_batches(max_chunksize=size)))).to_pylist()
        assert sorted(tuple(row.values()) for row in kept) == [("a", 3, 4), ("b", 7, 3), ("c", None, 1)]
    assert list(firsts(iter([]))) == []


def test_a_run_that_fails_after_its_state_was_kept_lands_once(spark, tmp_path, monkeypatch):
    batches = [[("A", "2024-01-01 10:00:00")], [("A", "2024-01-02 10:00:00"), ("B", "2024-01-02 10:00:00")]]

    def stop(*_, **__):
        raise OSError("lost here")

    with monkeypatch.context() as patch:
        patch.setattr(arrivals, "commit_batch", stop)
        with pytest.raises(Exception, match="lost here"):
            _distinct(spark, tmp_path, batches)
    assert _distinct(spark, tmp_path, batches) == [(IN_TIME, "A"), (IN_TIME, "B")]


# --- admission by records ---------------------------------------------------------


def _counted(spark, tmp_path, seconds=0.0, **limits):
    messages = counted_messages(spark, str(tmp_path / "topic"), str(tmp_path / "position"), seconds=seconds, **limits)
    query = land_stream(
        decode_lines(messages), str(tmp_path / "out"), str(tmp_path / "cp"), trigger={"processingTime": "0 seconds"}
    )
    return query


def _land_until(spark, tmp_path, query, done):
    for _ in range(300):
        if sum(e.documents + e.broken for e in committed(spark, str(tmp_path / "out"))) >= done:
            break
        query.awaitTermination(0.1)
    query.stop()
    return [e.documents + e.broken for e in committed(spark, str(tmp_path / "out"))]


def test_batches_by_records_across_files_and_restarts(spark, tmp_path):
    write_lines(tmp_path / "topic" / "a.json", [report(f"A{i:02}") for i in range(11)])
    write_lines(tmp_path / "topic" / "b.json", [report("B1"), "{torn", report("B2")])
    first = _land_until(spark, tmp_path, _counted(spark, tmp_path, most=4), 8)
    # A file that comes later and sorts before the others, and one that has grown.
    write_lines(tmp_path / "topic" / "0.json", [report("Z1"), report("Z2")])
    with open(tmp_path / "topic" / "b.json", "a") as grown:
        grown.write(json.dumps(report("B3")) + "\n")
    sizes = _land_until(spark, tmp_path, _counted(spark, tmp_path, most=4), 17)
    assert sizes[: len(first)] == first and sum(sizes) == 17 and max(sizes) == 4
    found = keys(read_landed(spark, str(tmp_path / "out")))
    assert found == sorted([*(f"A{i:02}" for i in range(11)), "B1", "B2", "B3", "Z1", "Z2"])


def test_a_batch_waits_for_count_or_age(tmp_path):
    topic = tmp_path / "topic"
    write_lines(topic / "a.json", ["x"] * 3)
    options = {"path": str(topic), "position": str(tmp_path / "p"), "most": "10", "least": "5", "seconds": "0.4"}
    reader = admission._Reader(options)
    assert reader.latestOffset() == {}
    with open(topic / "a.json", "a") as file:
        file.write("y\nz\nnot whole yet")
    assert reader.latestOffset() == {"a.json": 10}  # five whole lines
    with open(topic / "a.json", "a") as file:
        file.write(" now\n")
    assert reader.latestOffset() == {"a.json": 10}
    time.sleep(0.5)
    after = reader.latestOffset()
    assert after == {"a.json": 28}
    # A restart names the last offset once more and goes on from it.
    again = admission._Reader(options)
    assert again.latestOffset() == after and again.latestOffset() == after
    lines = [v for part in again.partitions({"a.json": 4}, after) for b in again.read(part) for v in b.column(0).to_pylist()]
    assert lines == ["x", "y", "z", "not whole yet now"]


# --- order within a key -----------------------------------------------------------


def test_messages_of_a_key_are_published_in_order(spark, tmp_path):
    rows = [{"safetyreportid": k, "receiptdate": d} for k, d in [("A", "3"), ("B", "1"), ("A", "1"), ("A", "2"), (None, "9")]]
    write_lines(tmp_path / "topic" / "a.json", rows)

    def publish():
        documents, _ = split_corrupt(decode_lines(file_messages(spark, str(tmp_path / "topic"))))
        position = [F.col("receiptdate").cast("int")]
        sink = to_files(str(tmp_path / "out"))
        publish_in_order(documents, "safetyreportid", position, sink, str(tmp_path / "cp")).awaitTermination()

    publish()
    write_lines(tmp_path / "topic" / "b.json", [{"safetyreportid": "A", "receiptdate": "0"}])
    publish()
    for entry in (tmp_path / "cp" / "commits").glob("*1*"):
        entry.unlink()
    publish()
    found, by_file = {}, {}
    for path in sorted(tmp_path.glob("out/batch=*/part-*")):
        for line in path.read_text().splitlines():
            row = json.loads(line)
            found.setdefault(row.get("safetyreportid"), []).append((row[SEQUENCE], row["receiptdate"]))
            by_file.setdefault((path, row.get("safetyreportid")), []).append(row[SEQUENCE])
    assert [day for _, day in sorted(found["A"])] == ["1", "2", "3", "0"]
    assert all(numbers == sorted(numbers) for numbers in by_file.values())
    assert len({path for path, key in by_file if key == "A"}) == 2  # one file a batch
    assert len(found[None]) == 1 and len(found["B"]) == 1


def test_a_task_before_the_shuffle_holds_a_bounded_number_of_rows():
    """Many different keys go on in parts; without a bound each key comes once, its first row."""
    from casewise.streaming.arrivals import _HELD, _firsts

    taken = []

    def batches():
        for start in range(0, 4 * _HELD, 1 << 12):
            taken.append(start)
            keys = np.arange(start, start + (1 << 12))
            yield pa.RecordBatch.from_pydict({"id": keys, "at": -keys, "_content": keys})

    first = next(_firsts("id", "at", _HELD // 2)(batches()))
    assert len(first) <= _HELD and len(taken) * (1 << 12) <= _HELD
    repeated = [pa.RecordBatch.from_pydict({"id": np.arange(50_000) % 7, "at": -np.arange(50_000), "_content": np.arange(50_000) + i}) for i in (1, 0)]
    (cut,) = _firsts("id", "at")(iter(repeated))
    assert sorted(cut.column("at").to_pylist()) == list(range(-49_999, -49_992)) and len(cut) == 7
