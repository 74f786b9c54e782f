"""Structured Streaming ingest."""

from casewise.sources.commits import committed

from .admission import counted_messages
from .arrivals import IN_TIME, LATE, first_arrivals, land_distinct, read_distinct
from .ingest import (
    BROKEN,
    DOCUMENT,
    batch_options,
    compact_landed,
    file_messages,
    kafka_messages,
    keyed_messages,
    land_stream,
    max_offsets,
    publish_to_files,
    publish_to_kafka,
    read_landed,
    replay_trigger,
    stream_id,
)
from .ordering import SEQUENCE, publish_in_order, to_files, to_kafka

__all__ = [
    "BROKEN",
    "DOCUMENT",
    "IN_TIME",
    "LATE",
    "SEQUENCE",
    "batch_options",
    "committed",
    "compact_landed",
    "counted_messages",
    "file_messages",
    "first_arrivals",
    "kafka_messages",
    "keyed_messages",
    "land_distinct",
    "land_stream",
    "max_offsets",
    "publish_in_order",
    "publish_to_files",
    "publish_to_kafka",
    "read_distinct",
    "read_landed",
    "replay_trigger",
    "stream_id",
    "to_files",
    "to_kafka",
]
