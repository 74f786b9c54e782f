"""Scans, sinks and the shared work folder."""

from .bronze import decode_lines, lost_lines, read_bronze, split_corrupt, union_bronze
from .landed import (
    newest_assessments,
    read_assessments,
    read_cases,
    read_ndjson,
    read_silver,
)
from .sinks import write_ndjson, write_partitioned_ndjson, write_summary, write_table
from .workspace import fresh_path, materialize, run_folder, shared_root

__all__ = [
    "decode_lines",
    "fresh_path",
    "lost_lines",
    "materialize",
    "newest_assessments",
    "read_assessments",
    "read_bronze",
    "read_cases",
    "read_ndjson",
    "read_silver",
    "run_folder",
    "shared_root",
    "split_corrupt",
    "union_bronze",
    "write_ndjson",
    "write_partitioned_ndjson",
    "write_summary",
    "write_table",
]
