"""Substring deduplication by sliding sentence spans.

A text is cut into sentences, and from each sentence on the shortest run of at least
``SENTENCES`` sentences and ``WORDS`` words is hashed, so spans slide over the text
sentence by sentence; one more run ends with the text's last sentence. A run that several
documents have belongs to the one with the smallest id; everywhere else, and where a text
repeats its own run, all sentences that the run covers are removed.

A passage may begin and end inside a sentence, and a stretch without sentence ends would be
one endless sentence. So sentences of more than ``LONG`` words are cut by winnowing: every gap
between two words has a hash of them, and a gap is cut that has the smallest one, ties
included, of any ``_WINDOW`` gaps in a row. What is cut inside a window so depends on the
window alone, and every window has a cut. Two places of a passage are cut alike from at most
``_WINDOW`` words behind its start to as many before its end, and a run takes fewer than
``WORDS + _WINDOW`` words, so that every passage of ``WORDS + 2 * _WINDOW`` = 50 words holds a
whole run, whatever its words are and wherever it stands; a sentence of up to ``LONG`` words,
which is shorter than a window, does not change that. (Sentence ends are cuts as well: a
passage is one of words and of sentence ends.)

The corpus-wide step works on hashes: runs are counted with map-side sums, runs of a single
document drop out, and a run that very many documents share is only met in a join whose
large side can be split. Hashes have 96 bits.

Words are compared, in lower case; spaces and punctuation do not matter. Null and empty
texts have no sentences and stay as they are. Rows that share an id count as one document:
they keep what one of them has first. Documents without an id come last, and keep runs that
only such documents have. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from casewise.llm.textops import byte_lists, fold, map_texts, small_batches
from casewise.sources.workspace import materialize

SENTENCES = 2
WORDS = 20
LONG = 12
_WINDOW = 15

_ENDS = np.isin(np.arange(256), [*b".!?"])
_BLANKS = np.isin(np.arange(256), [*b" \t\n\v\f\r"])
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)
_KEY = np.dtype([("h1", "<i8"), ("h2", "<i4")])


class Sentences(NamedTuple):
    """Where each sentence with a word begins, its words, and all hashes, 16 bytes each."""

    starts: np.ndarray
    counts: np.ndarray
    digests: bytes


def _over_windows(best: np.ufunc, values: np.ndarray) -> np.ndarray:
    """The least or greatest of every ``_WINDOW`` values in a row."""
    width = 1
    while width < _WINDOW:
        step = min(width, _WINDOW - width)
        values, width = best(values[:-step], values[step:]), width + step
    return values


def _chosen(words: list[bytes]) -> np.ndarray:
    """Per gap between two words, whether any window of gaps has no smaller hash than its."""
    hashes = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    gaps = hashes[:-1] * _FACTORS[0] + hashes[1:]
    gaps = (gaps ^ gaps >> np.uint64(32)) * _FACTORS[1]
    gaps ^= gaps >> np.uint64(29)
    if len(gaps) < _WINDOW:
        return np.zeros(len(gaps), bool)
    # Windows beyond either end count as empty: the least hash of each, and of these the
    # greatest around a gap, is its own hash where it is cut.
    least = np.pad(_over_windows(np.minimum, gaps), _WINDOW - 1)
    return _over_windows(np.maximum, least) == gaps


def sentences(text: bytes) -> Sentences:
    """The sentences of a text; each reaches up to the next one."""
    octets = np.frombuffer(text, np.uint8)
    folded = fold(text)
    words = folded.split()
    if not words:
        return Sentences(np.empty(0, np.int64), np.empty(0, np.int64), b"")
    letters = np.concatenate([[False], np.frombuffer(folded, np.uint8) != 0x20, [False]])
    edges = np.flatnonzero(letters[1:] != letters[:-1])
    firsts, lasts = edges[::2], edges[1::2]  # of the words
    ends = _ENDS[octets[:-1]] & _BLANKS[octets[1:]] | (octets[:-1] == 0x0A)
    breaks = np.concatenate([[0], np.flatnonzero(ends) + 1])
    owner = np.searchsorted(breaks, firsts, "right") - 1
    is_head = np.concatenate([[True], owner[1:] != owner[:-1]])
    heads = np.flatnonzero(is_head)
    sizes = np.diff(np.append(heads, len(words)))
    is_long = np.repeat(sizes > LONG, sizes)
    is_cut = is_head.copy()
    is_cut[1:] |= _chosen(words) & is_long[:-1]
    cuts = np.flatnonzero(is_cut)
    counts = np.diff(np.append(cuts, len(words)))
    starts = np.where(is_head[cuts], breaks[owner[cuts]], lasts[cuts - 1])
    spaced = b" ".join(words)
    places = np.concatenate([[0], np.cumsum(lasts - firsts + 1)])
    begins, stops = places[cuts].tolist(), (places[cuts + counts] - 1).tolist()
    digests = [xxh3_128_digest(spaced[a:b]) for a, b in zip(begins, stops, strict=True)]
    return Sentences(starts, counts, b"".join(digests))


def runs(found: Sentences, several: int, words: int) -> tuple[list[int], list[int], list[bytes]]:
    """First and one behind the last sentence of every run, and its hash of 12 bytes."""
    count = len(found.counts)
    total = np.concatenate([[0], np.cumsum(found.counts)])
    stops = np.searchsorted(total, total[:-1] + words)
    stops = np.maximum(stops, np.arange(count) + several)
    starts = np.arange(count)[stops <= count]
    stops = stops[stops <= count]
    if len(stops) and stops[-1] < count:
        # One more run ends with the last sentence.
        start = min(np.searchsorted(total, total[-1] - words, "right") - 1, count - several)
        starts, stops = np.append(starts, start), np.append(stops, count)
    spans = starts.tolist(), stops.tolist()
    keys = [xxh3_128_digest(found.digests[16 * a : 16 * b])[:12] for a, b in zip(*spans, strict=True)]
    return *spans, keys


def _owner() -> Column:
    """0, but for documents without an id a hash of their text."""
    return F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0))


def _hashes(docs: DataFrame, several: int, words: int) -> DataFrame:
    """``doc_id``, ``owner``, ``h1``, ``h2``: each run of a text once."""

    def make():
        def score(texts: list[bytes]) -> list[pa.Array]:
            keys = [list(dict.fromkeys(runs(sentences(text), several, words)[2])) for text in texts]
            flat = np.frombuffer(b"".join(chain.from_iterable(keys)), _KEY)
            offsets = np.cumsum([0, *map(len, keys)])
            pairs = [pa.array(np.ascontiguousarray(flat[name])) for name in ("h1", "h2")]
            struct = pa.StructArray.from_arrays(pairs, ["h1", "h2"])
            return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct)]

        return score

    keyed = docs.select("doc_id", "text", _owner().alias("owner"))
    found = map_texts(
        keyed, make, "runs array<struct<h1:bigint,h2:int>>", keep=("doc_id", "owner")
    )
    return found.select("doc_id", "owner", F.inline("runs"))


def repeated_runs(docs: DataFrame, several: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """``doc_id``, ``owner``, ``foreign``: the runs of a document that belong to another."""
    found = materialize(_hashes(docs, several, words), "substring-runs")
    firsts = (
        found.groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .select("h1", "h2", "first_id")
    )
    # Written, so that the join below reads two shuffles and can split a hot run.
    firsts = materialize(firsts, "substring-firsts")
    return (
        found.join(firsts, ["h1", "h2"])
        .where("doc_id IS NULL OR doc_id > first_id")
        .groupBy("doc_id", "owner")
        .agg(F.collect_set(F.struct("h1", "h2")).alias("foreign"))
    )


def _kept(text: bytes, foreign: set[bytes], several: int, words: int) -> tuple[bytes, int, int]:
    """The text without covered sentences, how many there were and how many went."""
    found = sentences(text)
    starts, stops, keys = runs(found, several, words)
    count = len(found.counts)
    if not foreign and len(set(keys)) == len(keys):
        return text, count, 0
    gone, seen = np.zeros(count, bool), set()
    for start, stop, key in zip(starts, stops, keys, strict=True):
        if key in seen or key in foreign:
            gone[start:stop] = True
        seen.add(key)
    edges = np.concatenate([[0], found.starts[1:], [len(text)]]).tolist()
    kept = [text[edges[i] : edges[i + 1]] for i in np.flatnonzero(~gone).tolist()]
    return b"".join(kept), count, int(gone.sum())


def _key_sets(column: pa.ListArray) -> list[set[bytes]]:
    """The foreign runs of each row, as the hashes that ``runs`` gives."""
    sizes = [0 if size is None else size for size in pc.list_value_length(column).to_pylist()]
    flat = column.flatten()
    keys = np.empty(len(flat), _KEY)
    for name in ("h1", "h2"):
        keys[name] = flat.field(name).to_numpy(zero_copy_only=False)
    joined, at, sets = keys.tobytes(), 0, []
    for size in sizes:
        sets.append({joined[i : i + 12] for i in range(at, at + 12 * size, 12)})
        at += 12 * size
    return sets


def drop_repeated_spans(
    docs: DataFrame, several: int = SENTENCES, words: int = WORDS
) -> DataFrame:
    """``doc_id``, ``n_sentences``, ``n_removed`` and the remaining ``text`` of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    narrow = narrow.withColumn("owner", _owner())
    foreign = repeated_runs(narrow, several, words).select(
        F.col("doc_id").alias("other_id"), F.col("owner").alias("other"), "foreign"
    )
    joined = narrow.join(
        foreign,
        F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("owner") == F.col("other")),
        "left",
    ).select("doc_id", "text", "foreign")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            foreign = _key_sets(batch.column("foreign"))
            rows = [
                _kept(text, keys, several, words)
                for text, keys in zip(byte_lists(texts), foreign, strict=True)
            ]
            missing = texts.is_null().to_pylist()
            cut = [None if no else row[0] for row, no in zip(rows, missing, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_sentences": pa.array([row[1] for row in rows], pa.int64()),
                    "n_removed": pa.array([row[2] for row in rows], pa.int64()),
                    "text": pa.array(cut, pa.binary()).cast(pa.string()),
                }
            )

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        run, f"doc_id {kind}, n_sentences bigint, n_removed bigint, text string"
    )
