"""Command line of the single jobs: ``python -m casewise <job> --help``."""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import functions as F

from casewise.functions import parse_partial_date
from casewise.operators.assessors import rule_assessor
from casewise.plans.enrichment import run_enrichment
from casewise.plans.evaluation import run_evaluation
from casewise.plans.landing import land
from casewise.plans.transform import run_transform
from casewise.session import build_session
from casewise.sources import decode_lines, read_bronze, read_cases, split_corrupt
from casewise.streaming import (
    batch_options,
    committed,
    counted_messages,
    file_messages,
    kafka_messages,
    keyed_messages,
    land_stream,
    publish_in_order,
    publish_to_files,
    publish_to_kafka,
    replay_trigger,
    stream_id,
    to_files,
    to_kafka,
)


def _land(spark, args) -> dict:
    documents, broken = split_corrupt(read_bronze(spark, args.source))
    received = parse_partial_date(F.col("receivedate"), F.col("receivedateformat"))
    cap = args.max_records_per_window or None
    start, end = (F.lit(text).cast("date") for text in (args.start, args.end))
    start, end = spark.range(1).select(start, end).first()
    names = ("safetyreportid", "safetyreportversion", "receiptdate", "receivedate")
    order = [*map(F.col, names), F.xxhash64("*").alias("content")]
    manifest = land(
        documents,
        received,
        order,
        start,
        end,
        args.root,
        ingest_date=args.ingest_date,
        window_days=args.window_days,
        max_records_per_window=cap,
        broken=broken,
    )
    return manifest.first().asDict()


def _transform(spark, args) -> dict:
    return run_transform(
        spark,
        args.bronze,
        args.silver,
        args.gold,
        min_rows=args.min_rows,
        max_null_rate=args.max_null_rate,
        max_corrupt_rate=args.max_corrupt_rate,
    )


def _enrich(spark, args) -> dict:
    return run_enrichment(
        read_cases(spark, args.cases),
        rule_assessor,
        args.gold,
        model_id="rules",
        cache_path=args.cache,
        limit=args.limit or None,
        ingest_date=args.ingest_date,
        waves=args.waves,
        resume_path=args.resume,
    )


def _evaluate(spark, args) -> dict:
    return run_evaluation(spark, args.assessments, args.out)


def _stream(spark, args) -> dict:
    if args.bootstrap:
        options = batch_options(args.least_records, args.max_seconds, args.most_records)
        messages = kafka_messages(spark, args.bootstrap, args.source, options)
    elif args.most_records and args.interval:
        position = f"{args.checkpoint.rstrip('/')}-position"
        limits = {"most": args.most_records, "least": args.least_records, "seconds": args.max_seconds}
        messages = counted_messages(spark, args.source, position, **limits)
    else:
        messages = file_messages(spark, args.source, args.files_per_batch)
    trigger = {"processingTime": f"{args.interval} seconds"} if args.interval else None
    day = F.lit(args.ingest_date) if args.ingest_date else None
    place = f"stream={stream_id(spark, args.checkpoint)}/"

    def landed() -> dict[int, int]:
        mine = (entry for entry in committed(spark, args.out) if entry.place.startswith(place))
        return {entry.batch: entry.documents + entry.broken for entry in mine}

    before = landed()
    query = land_stream(decode_lines(messages), args.out, args.checkpoint, day, trigger)
    done = lambda: {batch: n for batch, n in landed().items() if batch not in before}
    return _drained(query, args.interval, args.idle, args.max_batches, done)


def _by_progress(query) -> dict[int, int]:
    rows = {progress["batchId"]: progress["numInputRows"] for progress in query.recentProgress}
    return {batch: n for batch, n in rows.items() if n}


def _drained(query, interval: float | None, idle: float, max_batches: int | None, done=None) -> dict:
    """Wait for a query to end, or for a running one to be idle or to have done enough.

    ``done`` tells the records of each batch so far; without it, the query's progress does.
    """
    batches: dict[int, int] = {}
    quiet = time.monotonic()

    def note() -> None:
        batches.update(done() if done else _by_progress(query))

    while interval and query.isActive:
        before = len(batches)
        note()
        if len(batches) > before:
            quiet = time.monotonic()
        if (max_batches and len(batches) >= max_batches) or time.monotonic() - quiet > idle:
            query.stop()
        else:
            query.awaitTermination(min(1, idle))
    query.awaitTermination()
    note()
    return {"batches": len(batches), "records": sum(batches.values())}


def _publish(spark, args) -> dict:
    """Documents of a folder as keyed messages, to a topic or a folder, at a rate."""
    lines = file_messages(spark, args.source, args.files_per_batch, args.limit)
    documents, _ = split_corrupt(decode_lines(lines))
    trigger = None
    if args.rate:
        per_file = args.records_per_file
        trigger = replay_trigger(per_file, args.files_per_batch or 1, args.rate)
    messages = keyed_messages(documents, args.key)
    if args.order_by:
        sink = to_kafka(args.bootstrap, args.topic) if args.bootstrap else to_files(args.topic)
        position = [F.col(name) for name in args.order_by]
        query = publish_in_order(documents, args.key, position, sink, args.checkpoint, trigger)
    elif args.bootstrap:
        query = publish_to_kafka(messages, args.bootstrap, args.topic, args.checkpoint, trigger)
    else:
        query = publish_to_files(messages, args.topic, args.checkpoint, trigger)
    return _drained(query, 1.0 if trigger else None, args.idle, None)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="casewise", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("land", help="land documents of a date range with a manifest")
    job.add_argument("--source", required=True)
    job.add_argument("--root", required=True)
    job.add_argument("--start", required=True)
    job.add_argument("--end", required=True)
    job.add_argument("--ingest-date")
    job.add_argument("--window-days", type=int, default=7)
    job.add_argument("--max-records-per-window", type=int, default=0, help="0, the default, for no cap")
    job.set_defaults(run=_land)

    job = jobs.add_parser("transform", help="bronze to silver, cases and signals")
    job.add_argument("--bronze", required=True, nargs="+")
    job.add_argument("--silver", required=True)
    job.add_argument("--gold", required=True)
    job.add_argument("--min-rows", type=int, default=1)
    job.add_argument("--max-null-rate", type=float, default=0.05)
    job.add_argument("--max-corrupt-rate", type=float, default=0.0)
    job.set_defaults(run=_transform)

    job = jobs.add_parser("enrich", help="assess cases with the rule assessor")
    job.add_argument("--cases", required=True)
    job.add_argument("--gold", required=True)
    job.add_argument("--cache")
    job.add_argument("--limit", type=int, default=0, help="0, the default, for all")
    job.add_argument("--waves", type=int, default=1, help="with --resume: parts that are committed one by one")
    job.add_argument("--resume", help="a folder from which a broken-off run is taken up")
    job.add_argument("--ingest-date")
    job.set_defaults(run=_enrich)

    job = jobs.add_parser("evaluate", help="score landed assessments")
    job.add_argument("--assessments", required=True)
    job.add_argument("--out", required=True)
    job.set_defaults(run=_evaluate)

    job = jobs.add_parser("publish", help="replay documents as keyed messages")
    job.add_argument("--source", required=True)
    job.add_argument("--topic", required=True, help="a topic with --bootstrap, else a folder")
    job.add_argument("--bootstrap")
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--key", default="safetyreportid")
    job.add_argument("--order-by", nargs="+", help="fields that order the messages of a key, which are numbered")
    job.add_argument("--limit", type=int)
    job.add_argument("--rate", type=float, help="records per second; without, all at once")
    job.add_argument("--records-per-file", type=int, default=500)
    job.add_argument("--files-per-batch", type=int)
    job.add_argument("--idle", type=float, default=30, help="a rated replay ends so many seconds after its last batch")
    job.set_defaults(run=_publish)

    job = jobs.add_parser("stream", help="land what a topic or folder holds")
    job.add_argument("--source", required=True, help="a topic with --bootstrap, else a folder")
    job.add_argument("--bootstrap")
    job.add_argument("--out", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--least-records", type=int, default=200)
    job.add_argument("--most-records", type=int, help="of a folder with --interval only: files are cut where need be")
    job.add_argument("--max-seconds", type=int, default=10)
    job.add_argument("--files-per-batch", type=int)
    job.add_argument("--ingest-date")
    job.add_argument("--interval", type=float, help="seconds between batches; without, take what is there and stop")
    job.add_argument("--idle", type=float, default=30, help="seconds without data after which a running stream ends")
    job.add_argument("--max-batches", type=int)
    job.set_defaults(run=_stream)
    return parser


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    result = args.run(build_session(f"casewise-{args.job}"), args)
    print(json.dumps(result, indent=2, default=str))
    return 1 if result.get("status") in ("no_input", "failed") else 0


if __name__ == "__main__":
    sys.exit(main())
