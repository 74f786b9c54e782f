"""Which micro-batches of a landed folder are whole.

A batch lands in several folders, and no file system publishes those at once. So a batch counts
when its entry is in the log, which is written last and removed first when the batch is
written again. Readers take the folders of committed batches only; what a broken-off run
left behind is never seen, and is replaced when the batch runs again.
"""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

from casewise.sources.workspace import file_exists, remove_folder, write_whole

# Hidden from scans of the landed folder.
LOG = "_commits"

DOCUMENT, BROKEN = KINDS = ("documents", "broken")  # the folders of a landed stream

_ENTRY = "place STRING, batch BIGINT, documents BIGINT, broken BIGINT, newest TIMESTAMP"


def _entry(path: str, place: str) -> str:
    return f"{path}/{LOG}/{place}"


def drop_commit(spark: SparkSession, path: str, place: str) -> None:
    """The batch is about to be written again and counts for nothing until then."""
    remove_folder(spark, _entry(path, place))


def commit_batch(
    spark: SparkSession,
    path: str,
    place: str,
    batch: int,
    documents: int,
    broken: int = 0,
    newest: datetime | None = None,
) -> None:
    """All of the batch is written: make it seen, by one small file that appears whole.

    The driver writes it, as a few words need no Spark job of their own.
    """
    entry = {"place": place, "batch": batch, "documents": documents, "broken": broken}
    if newest is not None:
        entry["newest"] = newest.astimezone(UTC).isoformat(timespec="milliseconds")
    write_whole(spark, _entry(path, place), "entry.json", json.dumps(entry) + "\n")


def has_commit(spark: SparkSession, path: str, place: str) -> bool:
    """Whether this batch is whole, without reading the log."""
    return file_exists(spark, f"{_entry(path, place)}/entry.json")


def commit_log(spark: SparkSession, path: str) -> DataFrame | None:
    """An entry per committed batch, or None where nothing has ever been committed."""
    reader = spark.read.schema(_ENTRY).option("recursiveFileLookup", True)
    try:
        return reader.option("ignoreMissingFiles", True).json(f"{path}/{LOG}/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def committed(spark: SparkSession, path: str) -> list[Row]:
    """The log's entries in order: a few words for each micro-batch, no data."""
    log = commit_log(spark, path)
    return [] if log is None else sorted(log.collect(), key=lambda entry: (entry.batch, entry.place))


def landed_folders(spark: SparkSession, path: str, kind: str) -> list[str]:
    """The folders of all committed batches that have lines of this kind."""
    return [f"{path}/{kind}/{entry.place}" for entry in committed(spark, path) if entry[kind]]


def whole_batches(spark: SparkSession, path: str) -> list[str]:
    """The folders to scan for ``path``: itself, or those of its committed batches if it has a log."""
    if commit_log(spark, path) is None:
        return [path]
    return [folder for kind in KINDS for folder in landed_folders(spark, path, kind)]
