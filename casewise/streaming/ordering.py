"""Messages published in order within their key.

The messages of a key are sorted by their position in the one partition that publishes
them, and numbered. A number is the batch in its upper and the place in the batch in its lower
bits: it rises from message to message of a key, across batches and restarts, without
any state, and a batch that is run again gives the same ones. A consumer that reads several
files or partitions at once puts a key's messages back in order by it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SEQUENCE = "sequence"

# Bits for the place in a batch.
_PLACE_BITS = 33

Publish = Callable[[DataFrame, int], None]


def in_order(batch: DataFrame, batch_id: int, key: str, position: list[Column]) -> DataFrame:
    """The batch with ``sequence``, each key's rows in one partition, in order of their position.

    Ties fall to the content. Rows without a key have no order among themselves: they stay
    spread, with a number by content.
    """
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*batch.columns), F.lit(1024))).otherwise(F.lit(0))
    place = F.row_number().over(
        Window.partitionBy(key, "_spread").orderBy(*position, F.xxhash64(*batch.columns))
    )
    number = F.shiftleft(F.lit(batch_id).cast("bigint"), _PLACE_BITS) + place
    return batch.withColumn("_spread", spread).withColumn(SEQUENCE, number).drop("_spread")


def ordered_messages(batch: DataFrame, key: str) -> DataFrame:
    """(key, value) messages whose document carries its ``sequence``."""
    return batch.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def to_files(path: str) -> Publish:
    """Lines under a folder per batch, which a batch that is run again replaces."""

    def publish(messages: DataFrame, batch_id: int) -> None:
        messages.select("value").write.mode("overwrite").text(f"{path}/batch={batch_id}")

    return publish


def to_kafka(bootstrap: str, topic: str) -> Publish:
    """A topic; needs the Kafka connector on the class path. Its keys keep one partition each."""

    def publish(messages: DataFrame, batch_id: int) -> None:
        writer = messages.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
        options = {"kafka.acks": "all", "kafka.enable.idempotence": "true", "topic": topic}
        writer.options(**options).save()

    return publish


def publish_in_order(
    documents: DataFrame,
    key: str,
    position: list[Column],
    publish: Publish,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Publish a stream of documents, each key's in order of ``position`` within a batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        publish(ordered_messages(in_order(batch, batch_id, key, position), key), batch_id)

    return (
        documents.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
