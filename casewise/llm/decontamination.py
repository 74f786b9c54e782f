"""Benchmark decontamination: test n-grams in a broadcast hash set, verified, cut out.

A window is ``width`` consecutive words of a benchmark item; an item of fewer words, but
not none, is one window. Documents are scanned row-locally: a rolling hash over the words'
hashes finds the candidates, by a table of bits first, and every candidate is compared word
for word.

The benchmark is broadcast in blocks of about ``BLOCK_BYTES`` of text at most, distinct rows
dealt by the hash of id and text, so that no id makes a block large. A block's window set is
made once, on the driver: one buffer of text and a few sorted arrays, about four bytes in memory
for each byte of text, which a worker loads once for all of its tasks. A usual benchmark is one
block and one pass without a shuffle; a larger one takes a pass per block, and what the earlier
passes found is carried along in a written table.

Null and empty texts have no words and are clean. Items without an id or without words
are no items. Repeated documents give a row each, repeated items count once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xxhash import xxh3_64_intdigest

from casewise.llm.textops import byte_lists, fold, folded_words, ranges, small_batches
from casewise.sources.workspace import materialize

WIDTH = 10
BLOCK_BYTES = 16 << 20
# A document with more than this share of its words in test windows is dropped whole.
DROP_SHARE = 0.5

_ODD = np.uint64(0x9E3779B97F4A7C15)
_HITS = "array<struct<start:bigint,stop:bigint>>"


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


class WindowSet:
    """The windows of a block of items, by length.

    ``text`` is all words of all items, each with a space behind it; ``begins`` is where each
    word starts. Per length there are the windows' hashes in order, and the number of
    each window's first word.
    """

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        rows = [(item, words) for item, text in items if (words := folded_words(text))]
        self.names = [item for item, _ in rows]
        counts = np.array([len(words) for _, words in rows], np.int64)
        self.firsts = np.cumsum(counts) - counts  # of each item, its first word's number
        self.text = b"".join(word + b" " for _, words in rows for word in words)
        sizes = np.fromiter((len(word) + 1 for _, words in rows for word in words), np.int64)
        self.begins = np.concatenate([[0], np.cumsum(sizes)]).astype(np.uint32)
        hashes = _word_hashes([word for _, words in rows for word in words])
        lengths = np.minimum(counts, width)
        self.windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in np.unique(lengths).tolist():
            own = lengths == length
            starts = ranges(self.firsts[own], counts[own] - length + 1)
            keys = _rolled(hashes, length)[starts]
            owners = np.searchsorted(self.firsts, starts, "right")
            order = np.lexsort((starts, owners, keys))
            keys, starts, owners = keys[order], starts[order], owners[order]
            keep = np.ones(len(keys), bool)
            # A window that an item repeats is kept once.
            again = (keys[1:] == keys[:-1]) & (owners[1:] == owners[:-1])
            for at in (np.flatnonzero(again) + 1).tolist():
                keep[at] = self._window(starts[at - 1], length) != self._window(starts[at], length)
            self.windows[length] = keys[keep], starts[keep].astype(np.uint32)
        # One bit in a thousand set at most, so that few other windows get through.
        found = sum(len(keys) for keys, _ in self.windows.values())
        self.bits = min(27, max(16, found.bit_length() + 4))
        self.seen = np.zeros(1 << (self.bits - 3), np.uint8)
        for keys, _ in self.windows.values():
            place = keys >> np.uint64(64 - self.bits)
            np.bitwise_or.at(self.seen, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))

    def _window(self, at: int, length: int) -> bytes:
        return self.text[self.begins[at] : self.begins[at + length]]

    def _maybe(self, keys: np.ndarray) -> np.ndarray:
        """Where a hash may be one of the set's."""
        place = keys >> np.uint64(64 - self.bits)
        bit = self.seen[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)
        return np.flatnonzero(bit & np.uint8(1))

    def search(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """A flag per word, and the items of which a window occurs."""
        hit, items = np.zeros(len(words), bool), set()
        hashes = _word_hashes(words)
        for length, (keys, starts) in self.windows.items():
            rolled = _rolled(hashes, length)
            maybe = self._maybe(rolled)
            found = rolled[maybe]
            first, last = np.searchsorted(keys, found), np.searchsorted(keys, found, "right")
            known: dict[bytes, bool] = {}
            for start, a, b in zip(maybe.tolist(), first.tolist(), last.tolist(), strict=True):
                if a == b:
                    continue
                window = b" ".join(words[start : start + length]) + b" "
                if window not in known:
                    same = [at for at in starts[a:b].tolist() if self._window(at, length) == window]
                    owners = np.searchsorted(self.firsts, same, "right") - 1
                    items.update(self.names[owner] for owner in owners.tolist())
                    known[window] = bool(same)
                if known[window]:
                    hit[start : start + length] = True
        return hit, items


def _rolled(ids: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` numbers."""
    windows = max(0, len(ids) - length + 1)
    key = np.zeros(windows, np.uint64)
    for offset in range(length):
        key *= _ODD
        key += ids[offset : offset + windows]
        key ^= key >> np.uint64(29)
    return key


def _flagged_runs(hit: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"start": a, "stop": b} for a, b in edges.reshape(-1, 2).tolist()]


def _cut(text: bytes, hits: list[dict[str, int]]) -> bytes:
    """``text`` without its words in ``hits`` and what stands between them."""
    letters = np.frombuffer(fold(text), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate([[0], letters.astype(np.int8), [0]])))
    kept, at = [], 0
    for run in hits:
        kept.append(text[at : edges[2 * run["start"]]])
        at = int(edges[2 * run["stop"] - 1])
    return b"".join([*kept, text[at:]])


def _blocks(docs: DataFrame, benchmark: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The distinct items, dealt into blocks by the hash of their ids and texts."""
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")
    ).where("item IS NOT NULL AND text IS NOT NULL").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    if blocks > 1:
        items = materialize(items, "decontamination-items")
    place = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    return [items.where(place == block) for block in range(blocks)]


def _shared(items: DataFrame, width: int) -> Broadcast:
    """The window set of a block, whose bytes are bounded."""
    rows = [(row.item, row.text.encode()) for row in items.toLocalIterator()]
    return items.sparkSession.sparkContext.broadcast(WindowSet(rows, width))


def find_windows(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id`` and what was found in each text: ``n_words``, ``hits`` (runs of hit words)
    and ``items`` (ids, each once)."""
    small_batches(docs.sparkSession)
    found = docs.select(
        "doc_id",
        F.col("text").cast("string").alias("text"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast(_HITS).alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    for block, items in enumerate(_blocks(docs, benchmark, block_bytes)):
        if block:
            found = materialize(found, "decontamination-block")
        found = found.mapInArrow(_scanner(_shared(items, width)), found.schema)
    return found


def _scanner(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            texts = columns["text"].cast(pa.binary()).to_pylist()
            before = zip(columns["hits"].to_pylist(), columns["items"].to_pylist(), strict=True)
            counts, hits, items = [], [], []
            for text, (runs, owners) in zip(texts, before, strict=True):
                words = folded_words(text or b"")
                hit, more = windows.search(words)
                for one in runs:
                    hit[one["start"] : one["stop"]] = True
                counts.append(len(words))
                hits.append(_flagged_runs(hit))
                items.append(sorted(more.union(owners)))
            columns["n_words"] = pa.array(counts, pa.int64())
            columns["hits"] = pa.array(hits, columns["hits"].type)
            columns["items"] = pa.array(items, columns["items"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document: id, words, hit words, item ids, and whether anything was hit."""
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, run: n + run.stop - run.start)
    return (
        find_windows(docs, benchmark, **options)
        .select("doc_id", "n_words", n_hit.alias("n_hit"), F.array_sort("items").alias("items"), "hits")
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def _cleaned(text: bytes, windows: WindowSet) -> tuple[bytes, float]:
    """The text without test words, and the share of its words that were.

    What a cut joins is searched again, so that no window survives."""
    words = folded_words(text)
    hit, _ = windows.search(words)
    share = float(hit.mean()) if len(words) else 0.0
    while hit.any():
        text = _cut(text, _flagged_runs(hit))
        hit, _ = windows.search(folded_words(text))
    return text, share


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    drop_share: float = DROP_SHARE,
    width: int = WIDTH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` without test passages; clean rows stay as they are.

    A document of which more than ``drop_share`` is test text goes whole; from the others the
    hit words go. Share and cuts come from the hits of all blocks together, so they do not
    depend on the number of blocks. Columns other than the text stay in the JVM.
    """
    small_batches(docs.sparkSession)
    blocks = _blocks(docs, benchmark, block_bytes)
    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    if len(blocks) == 1:
        rows = rows.select("row", _cleaner(_shared(blocks[0], width))("text").alias("clean"))
        rows = rows.where(F.col("clean.share") <= drop_share)
        text = F.when(F.col("clean.share") > 0, F.col("clean.text")).otherwise(F.col("row.text"))
        return _with_text(rows, text, docs.columns)
    found = _marked(rows, blocks, width).where(F.col("marks.share") <= drop_share)
    done = [_with_text(found.where("size(marks.hits) = 0"), F.col("row.text"), docs.columns)]
    while True:
        # What a cut joins is searched again in all blocks, so that no window survives.
        hit = found.where("size(marks.hits) > 0")
        if hit.isEmpty():
            return reduce(DataFrame.unionByName, done)
        cut = hit.select("row", _cutter()("text", "marks.hits").alias("text"))
        found = _marked(cut, blocks, width)
        done.append(_with_text(found.where("size(marks.hits) = 0"), F.col("text"), docs.columns))


def _with_text(rows: DataFrame, text: Column, columns: list[str]) -> DataFrame:
    return rows.select(
        *(text.alias("text") if name == "text" else F.col(f"row.`{name}`") for name in columns)
    )


def _marked(rows: DataFrame, blocks: list[DataFrame], width: int) -> DataFrame:
    """``rows`` with ``marks``: the hits of all blocks in the text, and their share of its words."""
    kind = f"struct<hits:{_HITS},share:double>"
    rows = rows.withColumn("marks", F.lit(None).cast(kind))
    for items in blocks:
        mark = _marker(_shared(items, width))("text", "marks.hits")
        rows = materialize(rows.withColumn("marks", mark), "decontamination-block")
    return rows


def _marker(shared: Broadcast):
    @F.arrow_udf(f"hits {_HITS}, share double")
    def mark(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        windows = shared.value
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for texts, before in columns:
            hits, shares = [], []
            for text, runs in zip(byte_lists(texts), before.to_pylist(), strict=True):
                hit, _ = windows.search(folded_words(text))
                for one in runs or []:
                    hit[one["start"] : one["stop"]] = True
                hits.append(_flagged_runs(hit))
                shares.append(float(hit.mean()) if len(hit) else 0.0)
            yield pa.StructArray.from_arrays(
                [pa.array(hits, kind), pa.array(shares, pa.float64())], ["hits", "share"]
            )

    return mark


def _cutter():
    @F.arrow_udf("string")
    def cut(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, hits in columns:
            pairs = zip(byte_lists(texts), hits.to_pylist(), strict=True)
            yield pa.array([_cut(*pair) for pair in pairs], pa.binary()).cast(pa.string())

    return cut


def _cleaner(shared: Broadcast):
    @F.arrow_udf("text string, share double")
    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        windows = shared.value
        for one in texts:
            rows = [_cleaned(text, windows) for text in byte_lists(one)]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([text for text, _ in rows], pa.binary()).cast(pa.string()),
                    pa.array([share for _, share in rows], pa.float64()),
                ],
                ["text", "share"],
            )

    return clean.asNondeterministic()  # or a filter on its result would run it again
