"""The first arrival of every key, by keyed state.

What has been seen is a key in the stream's state store, on the executors' disks and in the
checkpoint, whatever event time a repeat has. The rows of a key in one batch are cut to the
first of them in Arrow, within each input task before the shuffle and once more behind it, so
a key that a third of all messages repeat is a few rows per task when it is shuffled. A task in
front of the shuffle holds a bounded number of rows; behind it there are many small ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from casewise.sources.commits import commit_batch, committed, drop_commit

IN_TIME, LATE = "in_time", "late"

_CONTENT, _PLACE, _UNTIMED = "_content", "_place", "_untimed"

_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A batch uploads what it changed, not the whole store.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Rows that are held before a cut, and at most by a task in front of the shuffle.
_HELD = 1 << 16
# Tasks behind the shuffle for each partition of the state: each holds the keys of one.
_FINER = 16


def _firsts(key: str, event_time: str, most: int | None = None):
    """Of each key of a partition the row that is first by event time, then by content.

    With ``most``, what is held goes on once it has so many keys: a key may then come again.
    """

    def cut(table: pa.Table) -> pa.Table:
        timed = table.append_column(_UNTIMED, pc.is_null(table[event_time]))
        order = [(name, "ascending") for name in (_UNTIMED, event_time, _CONTENT)]
        ordered = timed.take(pc.sort_indices(timed, sort_keys=order)).drop_columns([_UNTIMED])
        places = pa.table({key: ordered[key], _PLACE: np.arange(len(ordered))})
        return ordered.take(places.group_by(key).aggregate([(_PLACE, "min")])[f"{_PLACE}_min"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Cut whenever it has doubled, so what is held are the keys of a partition of one batch.
        held, rows, limit = [], 0, _HELD
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            rows += len(batch)
            if rows >= limit:
                table = cut(pa.concat_tables(held))
                if most and len(table) >= most:
                    yield from table.combine_chunks().to_batches()
                    held, rows, limit = [], 0, _HELD
                else:
                    held, rows, limit = [table], len(table), max(_HELD, 2 * len(table))
        if held:
            yield from cut(pa.concat_tables(held)).combine_chunks().to_batches()

    return run


def first_arrivals(stream: DataFrame, key: str, event_time: str) -> DataFrame:
    """The stream without rows whose key an earlier batch, or an earlier row of the batch, had.

    Rows without a key are all kept.
    """
    keyed = stream.where(F.col(key).isNotNull()).withColumn(_CONTENT, F.xxhash64(*stream.columns))
    partitions = _FINER * int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = keyed.mapInArrow(_firsts(key, event_time, _HELD // 2), keyed.schema)
    cut = few.repartition(partitions, key).mapInArrow(_firsts(key, event_time), keyed.schema)
    new = cut.dropDuplicates([key]).drop(_CONTENT)
    return new.unionByName(stream.where(F.col(key).isNull()))


def land_distinct(
    stream: DataFrame,
    key: str,
    event_time: str,
    delay: str,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Land the first arrival of every key as Parquet, late ones in an output of their own.

    A row is late when it is older, by more than ``delay``, than the newest row that the
    batches before have landed, or has no event time. Nothing is dropped but repeats of a key,
    however far apart their event times are; rows without a key are all kept. The state
    holds a key for each row that has landed with one. A batch that is run again finds
    the state as it was before it and replaces what it wrote; readers see whole batches only.
    """
    spark = stream.sparkSession
    for name, value in _STATE.items():
        spark.conf.set(name, value)
    names = stream.columns

    def write(batch: DataFrame, batch_id: int) -> None:
        before = [e.newest for e in committed(spark, path) if e.batch < batch_id and e.newest]
        newest = max(before, default=None)
        place = f"batch={batch_id}"
        drop_commit(spark, path, place)
        mark = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        in_time = F.col(event_time).isNotNull() & F.coalesce(F.col(event_time) >= mark, F.lit(True))
        judged = batch.withColumn("kind", F.when(in_time, IN_TIME).otherwise(LATE)).persist()
        (
            judged.select(*names, "kind")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("kind")
            .parquet(f"{path}/rows/{place}")
        )
        rows, latest = judged.agg(F.count(F.lit(1)), F.max(event_time)).first()
        judged.unpersist()
        commit_batch(spark, path, place, batch_id, rows, newest=latest)

    return (
        first_arrivals(stream, key, event_time)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields]).add("kind", T.StringType())


def _read(spark: SparkSession, folders: list[str], schema: T.StructType) -> DataFrame:
    """The rows of batches, with ``kind`` from the folder's name."""
    kind = F.regexp_extract(F.col("_metadata.file_path"), r"/kind=([^/]*)/", 1).alias("kind")
    reader = spark.read.schema(schema).option("recursiveFileLookup", True)
    return reader.parquet(*folders).select("*", kind)


def read_distinct(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``land_distinct`` has landed in whole batches, with ``kind``: in time or late."""
    folders = [f"{path}/rows/{entry.place}" for entry in committed(spark, path) if entry.documents]
    if not folders:
        return spark.createDataFrame([], _stored(schema))
    return _read(spark, folders, schema)
