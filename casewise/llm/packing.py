"""Packing documents into fixed-size sequences: best-fit decreasing on a segment tree.

A document's tokens are followed by the end token. Overlong documents are first cut into
full windows, which are sequences of their own. The remaining tails go, longest first,
into the open sequence with the least room that still holds them; a segment tree over the
remaining capacities finds it in a logarithmic number of steps.

Tokenising and packing happen in the task that reads the documents, in blocks of about
``block_tokens`` tokens: nothing is shuffled, a task's memory is bounded however long its
texts are in sum, and a block leaves no more than one sequence half empty. A sequence id
is the task's partition above the sequence's number there, so a task that runs again gives
the same ids.

A null text is an empty one and gives a piece with the end token alone. Repeated rows are
packed each. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from casewise.llm.textops import byte_lists, ranges, small_batches

SEQUENCE = 2048
END = 1
BLOCK_TOKENS = 4 << 20
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

PIECES = (
    "doc_id {id}, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)

# Words that a worker remembers with their tokens; then it starts afresh.
_REMEMBERED = 700_000
# Spaces other than a single space or line end between words: a token may cross them.
_ODD_BYTES = b"\t\v\f\r\x1c\x1d\x1e\x1f"
_ODD_SPACES = [b"  ", b" \n", b"\n ", b"\xe2\x80", *(c.encode() for c in "\x85\xa0\u1680\u205f\u3000")]


def _plain(text: bytes) -> bool:
    return not (
        text[:1] == b" "
        or text[-1:] == b" "
        or len(text.translate(None, _ODD_BYTES)) != len(text)
        or any(odd in text for odd in _ODD_SPACES)
    )


def _slices(column: pa.LargeBinaryArray) -> list[bytes]:
    """The values of a column without nulls, faster than one by one."""
    _, offsets, data = column.buffers()
    if not len(column):
        return []
    places = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset).tolist()
    joined = data.to_pybytes() if data else b""
    return [joined[a:b] for a, b in zip(places, places[1:], strict=False)]


class Tokens:
    """Token ids of texts; words that came before are not encoded again.

    Where a text has only single spaces between its words, no token crosses from one word
    into the next, so the text's tokens are those of its words. The words of a batch are
    made distinct, those that are new are encoded as one text and told apart by the lengths
    of their tokens, and every text is put together from a pool of tokens. A text's first
    word has no space before it and is encoded on its own. Texts with other spaces are
    encoded whole.
    """

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "ranks",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens={},
        )
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.places: dict[bytes, int] = {}
        self.pool, self.starts = np.empty(0, "<u4"), np.zeros(1, np.int64)

    def whole(self, text: bytes) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text.decode("utf-8", "replace")), "<u4")

    def _learn(self, words: list[bytes]) -> None:
        ids = self.whole(b"".join([b" " + word for word in words]))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        stops = np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
        known = len(self.places)
        self.places.update(zip(words, range(known, known + len(words)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.pool) + stops])
        self.pool = np.concatenate([self.pool, ids])

    def _from_words(self, texts: list[bytes]) -> list[np.ndarray]:
        lists = pc.split_pattern(pa.array(texts, pa.large_binary()), pattern=b" ")
        coded = lists.flatten().dictionary_encode()
        words, use = _slices(coded.dictionary), coded.indices.to_numpy()
        firsts = lists.offsets.to_numpy()
        leads = [words[i] for i in use[firsts[:-1]].tolist()]
        if len(self.places) > _REMEMBERED:
            self._forget()
        new = [word for word in words if word not in self.places]
        if new:
            self._learn(new)
        places = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        begin = self.starts[places][use]
        count = (self.starts[places + 1] - self.starts[places])[use]
        lead_ids = [self.whole(word) for word in leads]
        sizes = np.array([len(ids) for ids in lead_ids], np.int64)
        begin[firsts[:-1]] = len(self.pool) + np.cumsum(sizes) - sizes
        count[firsts[:-1]] = sizes
        out = np.concatenate([self.pool, *lead_ids])[ranges(begin, count)]
        ends = np.cumsum(count)[firsts[1:] - 1]
        return np.split(out, ends[:-1])

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of every text."""
        plain = list(map(_plain, texts))
        some = [text for text, one in zip(texts, plain, strict=True) if one]
        done = iter(self._from_words(some) if some else [])
        return [next(done) if one else self.whole(text) for text, one in zip(texts, plain, strict=True)]


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


class OpenSequences:
    """Open sequences by the room they have left, under a tree of counts."""

    def __init__(self, size: int):
        self.base = 1 << size.bit_length()
        self.counts = [0] * (2 * self.base)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, room: int, change: int) -> None:
        node = room + self.base
        while node:
            self.counts[node] += change
            node >>= 1

    def put(self, room: int, sequence: int) -> None:
        if room:
            self.open[room].append(sequence)
            self._add(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """The tightest open sequence with room for ``length``, and its room."""
        node, counts = length + self.base, self.counts
        while not counts[node]:
            while node & 1:  # a right child has nothing larger beside it
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.base:
            node = 2 * node if counts[2 * node] else 2 * node + 1
        room = node - self.base
        self._add(room, -1)
        return self.open[room].pop(), room


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each tail its sequence, numbered from 0, and its offset there."""
    places, opened, used = OpenSequences(size), np.zeros(len(lengths), np.int64), 0
    offsets = np.zeros(len(lengths), np.int64)
    for tail in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[tail])
        found = places.take(length)
        if found is None:
            found = (used, size)
            used += 1
        sequence, room = found
        opened[tail], offsets[tail] = sequence, size - room
        places.put(room - length, sequence)
    return opened, offsets


def _pack(ids: list[bytes], size: int, first: int) -> tuple[list[np.ndarray], int]:
    """Document, start, length, sequence and offset of all pieces, and the next sequence."""
    totals = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    full, rest = totals // size, totals % size
    windows = int(full.sum())
    tails = np.flatnonzero(rest)
    opened, offsets = best_fit(rest[tails], size)
    docs = np.concatenate([np.repeat(np.arange(len(ids)), full), tails])
    starts = np.concatenate([ranges(np.zeros(len(ids), np.int64), full), full[tails]]) * size
    lengths = np.concatenate([np.full(windows, size), rest[tails]])
    sequences = first + np.concatenate([np.arange(windows), windows + opened])
    places = np.concatenate([np.zeros(windows, np.int64), offsets])
    used = windows + (int(opened.max()) + 1 if len(opened) else 0)
    return [docs, starts, lengths, sequences, places], first + used


def pack(
    docs: DataFrame,
    ranks: str = RANKS,
    size: int = SEQUENCE,
    end: int = END,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per piece: where it stands in its document and in its sequence, with its ids."""
    small_batches(docs.sparkSession)
    narrow = docs.selectExpr("doc_id", "cast(text AS string) AS text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    closing = np.array([end], "<u4").tobytes()

    def rows(held: list[tuple[pa.Array, list[bytes]]], first: int):
        ids = [one for _, many in held for one in many]
        doc_ids = pa.chunked_array([column for column, _ in held]).combine_chunks()
        (docs, starts, lengths, sequences, offsets), after = _pack(ids, size, first)
        for at in range(0, len(docs), 2000):
            cut = slice(at, at + 2000)
            spans = zip(docs[cut].tolist(), starts[cut].tolist(), lengths[cut].tolist(), strict=True)
            columns = {
                "doc_id": doc_ids.take(pa.array(docs[cut])),
                "start": pa.array(starts[cut]),
                "length": pa.array(lengths[cut]),
                "ids": pa.array([ids[d][4 * s : 4 * (s + n)] for d, s, n in spans], pa.binary()),
                "doc_tokens": pa.array([len(ids[d]) // 4 for d in docs[cut].tolist()], pa.int64()),
                "sequence_id": pa.array(sequences[cut]),
                "offset": pa.array(offsets[cut]),
            }
            yield pa.RecordBatch.from_pydict(columns), after

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens(ranks)
        held, count, next_sequence = [], 0, TaskContext.get().partitionId() << 40
        for batch in batches:
            found = encoder.encode(byte_lists(batch.column("text")))
            ids = [one.tobytes() + closing for one in found]
            held.append((batch.column("doc_id"), ids))
            count += sum(map(len, ids)) // 4
            if count >= block_tokens:
                for out, after in rows(held, next_sequence):
                    yield out
                held, count, next_sequence = [], 0, after
        if held:
            for out, _ in rows(held, next_sequence):
                yield out

    return narrow.mapInArrow(run, PIECES.format(id=kind))
