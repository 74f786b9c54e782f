"""The shared work folder, and tables written there to cut lineage.

A written table survives the loss of any executor, and what reads it gets column
pruning and real file statistics. The folder is the one the cluster names in
``spark.checkpoint.dir``; a folder of our own is made only on a local master with
that setting unset. A job puts all of its tables into one folder and removes that
when it ends.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def shared_root(spark: SparkSession) -> str:
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{_SETTING} must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="casewise-")
    spark.conf.set(_SETTING, own)
    return own


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the work folder, or the run's part of it, that nothing has used yet."""
    folder = _run_folder.get() or f"{shared_root(spark)}/casewise"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def _store(spark: SparkSession, name: str) -> tuple:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that nothing reads any more; none is fine."""
    store, path = _store(spark, folder)
    store.delete(path, True)


def file_exists(spark: SparkSession, file: str) -> bool:
    store, path = _store(spark, file)
    return store.exists(path)


def write_whole(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """One small file in a folder that replaces any other: scans see all of it or none."""
    store, hidden = _store(spark, f"{folder}/_{name}")
    remove_folder(spark, folder)
    out = store.create(hidden, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    if not store.rename(hidden, spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")):
        raise OSError(f"cannot rename {folder}/_{name}")


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for the tables of one run; it goes when the run ends, failed or not.

    Nothing that reads these tables may leave the block. A run inside a run shares its
    folder.
    """
    if outer := _run_folder.get():
        yield outer
        return
    folder = fresh_path(spark, "run")
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        remove_folder(spark, folder)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the work folder and return the written table."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
