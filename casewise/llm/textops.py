"""What the text operators share: word splitting, Arrow plumbing, ranges, bounded samples.

Texts travel to Python as bytes and are split as bytes: every separator is ASCII, so no
text is decoded unless an operator needs its code points.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Lower-cased letters, digits and everything beyond ASCII are kept; the rest separates.
_FOLD = bytes(
    byte if byte >= 0x80 or 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A
    else byte + 32 if 0x41 <= byte <= 0x5A
    else 0x20
    for byte in range(256)
)
_LOWER = bytes(byte + 32 if 0x41 <= byte <= 0x5A else byte for byte in range(256))

# A worker holds a few batches at a time, so their bytes bound its memory.
_BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}

Make = Callable[[], Callable[[list[bytes]], list[pa.Array]]]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(text: bytes) -> bytes:
    """A-Z lower-cased, every other ASCII byte that is no letter or digit made a space."""
    return text.translate(_FOLD)


def lower(text: bytes) -> bytes:
    return text.translate(_LOWER)


def folded_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.translate(_FOLD).split()


def word_numbers(words: list[bytes]) -> tuple[np.ndarray, dict[bytes, int]]:
    """Each word's number in order of first appearance, and the numbering."""
    seen: dict[bytes, int] = {}
    number = seen.setdefault
    ids = np.fromiter((number(word, len(seen)) for word in words), np.int64, len(words))
    return ids, seen


def byte_lists(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of ``start, start + 1, ...`` with ``count`` members each."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(before, counts) + np.repeat(starts, counts)


def small_batches(spark: SparkSession) -> None:
    for name, value in _BATCH.items():
        spark.conf.set(name, value)


def map_texts(docs: DataFrame, make: Make, fields: str, keep: tuple[str, ...] = ("doc_id",)):
    """One row per document: the ``keep`` columns and what ``make()`` says of its text.

    ``make`` runs once per task and returns a function from a list of UTF-8 texts to the
    columns of ``fields``. Columns of ``docs`` beyond these are not read, so their names
    cannot clash.
    """
    small_batches(docs.sparkSession)
    narrow = docs.select(*keep, F.col("text").cast("string").alias("text"))
    added = T.StructType.fromDDL(fields)
    schema = T.StructType([narrow.schema[name] for name in keep] + added.fields)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for batch in batches:
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                columns + score(byte_lists(batch.column(len(keep)))), names
            )

    return narrow.mapInArrow(run, schema)



def text_value(make: Make, kind: str) -> Callable[[Column], Column]:
    """The one column that ``make()`` gives, as a function of a text column."""

    @F.arrow_udf(kind)
    def value(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = make()
        for one in texts:
            yield score(byte_lists(one))[0]

    return value
