"""Quality rules: a hashed n-gram logistic regression, calibrated, against fixed thresholds.

A text is two histograms side by side: its words and pairs of words, and its runs of four
characters, each hashed to ``2 ** BITS`` places, under a square root and scaled to length one.
A logistic regression is trained on most of a bounded sample of labelled texts; the rest
of the sample turns its margin into a probability. Rules that need no training come first:
a text that is too short or repeats itself fails whatever the probability is.

Scoring is row-local, in Arrow batches, over whole texts.

Null and empty texts have no words and fail the rules. Without labelled rows of both labels
the probability is the smoothed share of label 1, 0.5 at no rows. Repeated rows are judged
each, an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewise.llm.textops import map_texts, word_numbers
from casewise.llm.training import calibrate, sampled_labels, sampled_texts

ROWS = 5000
LONGEST = 50_000
BITS = 15
GRAM = 4
STEPS = 150
RATE = 2.0
SHRINK = 1e-5
# Fixed thresholds.
LEAST_WORDS = 50
MOST_REPEATED = 0.5
LEAST_CHANCE = 0.3

_SIZE = 1 << BITS
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\v\f\r"


def _places(keys: np.ndarray) -> np.ndarray:
    return (keys * _ODD >> np.uint64(64 - BITS)).astype(np.int64)


def _unit(counts: np.ndarray) -> np.ndarray:
    root = np.sqrt(counts).astype(np.float32)
    total = counts.sum()  # the squared length under the root
    return root / np.float32(np.sqrt(total)) if total else root


def histogram(text: bytes, ids: np.ndarray, distinct: list[bytes]) -> np.ndarray:
    """Both histograms of a text whose words are ``distinct[ids]``."""
    keys = np.fromiter(map(zlib.crc32, distinct), np.uint64, len(distinct))[ids]
    pairs = keys[:-1] * np.uint64(0x100000001B3) + keys[1:] + np.uint64(1)
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    runs = np.zeros(max(0, len(points) - GRAM + 1), np.uint64)
    for place in range(GRAM):
        runs *= np.uint64(0x100000001B3)
        runs += points[place : place + len(runs)]
    words = np.bincount(np.concatenate([_places(keys), _places(pairs)]), minlength=_SIZE)
    return np.concatenate([_unit(words), _unit(np.bincount(_places(runs), minlength=_SIZE))])


@dataclass
class Regression:
    """``scale`` and ``shift`` turn the margin into the logit of a calibrated probability."""

    weights: np.ndarray
    scale: float
    shift: float

    def chance(self, values: np.ndarray) -> float:
        logit = self.scale * float((values * self.weights).sum()) + self.shift
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


class _Rows:
    """Sparse rows in blocks, so that what is expanded for a product stays small."""

    def __init__(self, places: list[np.ndarray], values: list[np.ndarray], block: int = 250):
        self.blocks = [
            (
                np.concatenate(places[at : at + block]),
                np.concatenate(values[at : at + block]),
                np.array([len(one) for one in places[at : at + block]], np.int64),
            )
            for at in range(0, len(places), block)
        ]

    def times(self, weights: np.ndarray) -> np.ndarray:
        parts = [
            np.bincount(np.repeat(np.arange(len(sizes)), sizes), values * weights[places], len(sizes))
            for places, values, sizes in self.blocks
        ]
        return np.concatenate(parts)

    def transposed(self, rows: np.ndarray) -> np.ndarray:
        total, at = np.zeros(2 * _SIZE), 0
        for places, values, sizes in self.blocks:
            own = np.repeat(rows[at : at + len(sizes)], sizes)
            total += np.bincount(places, values * own, 2 * _SIZE)
            at += len(sizes)
        return total


def _logistic(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(places: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray) -> Regression:
    """Gradient descent with momentum on three quarters, calibration on the last."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    flat = Regression(np.zeros(2 * _SIZE), 1.0, float(np.log(share / (1 - share))))
    part = np.random.default_rng(5).permutation(len(labels)) % 4
    train, held = np.flatnonzero(part), np.flatnonzero(part == 0)
    for some in (train, held):
        if not len(some) or labels[some].min() == labels[some].max():
            return flat
    rows = _Rows([places[i] for i in train], [values[i] for i in train])
    truth = labels[train]
    weight = np.where(truth == 1, 0.5 / truth.sum(), 0.5 / (1 - truth).sum())
    weights, speed, bias = np.zeros(2 * _SIZE), np.zeros(2 * _SIZE), 0.0
    for _ in range(STEPS):
        slack = weight * (truth - _logistic(rows.times(weights) + bias))
        speed = 0.9 * speed + rows.transposed(slack) - SHRINK * weights
        weights = weights + RATE * speed
        bias += RATE * slack.sum()
    rest = _Rows([places[i] for i in held], [values[i] for i in held])
    scale, shift = calibrate(rest.times(weights), labels[held], balanced=False)
    return Regression(weights, scale, shift)


def train(docs: DataFrame, labels: DataFrame, allowed: Column, rows: int = ROWS) -> Regression:
    """A model from at most ``rows`` labelled texts whose ``doc_id`` is ``allowed``."""
    texts = sampled_texts(docs, sampled_labels(labels, "quality", allowed, rows), LONGEST)

    def make():
        def score(texts: list[bytes]) -> list[pa.Array]:
            rows = [_sparse(text) for text in texts]
            return [
                pa.array([places for places, _ in rows], pa.list_(pa.int32())),
                pa.array([values for _, values in rows], pa.list_(pa.float32())),
            ]

        return score

    sparse = map_texts(texts, make, "p array<int>, v array<float>", keep=("doc_id", "label"))
    found = sparse.toArrow()
    order = np.argsort(found["doc_id"].to_numpy())
    parts = [_pieces(found[name].combine_chunks(), order) for name in ("p", "v")]
    return fit(*parts, found["label"].to_numpy()[order].astype(float))


def _sparse(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids, seen = word_numbers(text.split())
    values = histogram(text, ids, [*seen])
    places = np.flatnonzero(values)
    return places.astype(np.int32), values[places]


def _pieces(column: pa.ListArray, order: np.ndarray) -> list[np.ndarray]:
    if isinstance(column, pa.ChunkedArray):  # of no rows
        return []
    flat, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    return [flat[offsets[i] : offsets[i + 1]] for i in order]


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words in runs of three that the text has more than once, first ones included."""
    if len(ids) < 4:
        return 0
    if distinct < 1 << 21:
        keys = (ids[:-2] * distinct + ids[1:-1]) * distinct + ids[2:]
    else:
        pairs = np.unique(ids[:-2] * distinct + ids[1:-1], return_inverse=True)[1]
        keys = pairs * distinct + ids[2:]
    _, back, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = counts[back] > 1
    hit = np.zeros(len(ids), bool)
    for place in range(3):
        hit[place : place + len(again)] |= again
    return int(hit.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(_SPACES)]
    return len(lines) - len(set(lines))


def judge(text: bytes, model: Regression) -> tuple[int, int, int, int, int, float]:
    """Words, their characters, symbols, repeated lines and words, and the probability."""
    words = text.split()
    ids, seen = word_numbers(words)
    spaces = sum(text.count(space) for space in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))
    octets = np.frombuffer(text, np.uint8)
    inner = int(((octets & 0xC0) == 0x80).sum())  # bytes of a character after its first
    by_byte = np.bincount(octets, minlength=256)
    return (
        len(words),
        len(text) - inner - spaces,
        int(by_byte[[*_SYMBOLS]].sum()),
        repeated_lines(text),
        repeated_words(ids, len(seen)),
        model.chance(histogram(text, ids, [*seen])),
    )


def apply_rules(docs: DataFrame, model: Regression) -> DataFrame:
    """``doc_id``, the counts, ``chance``, ``base_failed`` and ``kept`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def score(texts: list[bytes]) -> list[pa.Array]:
            rows = [judge(text, shared.value) for text in texts]
            kinds = [pa.int64()] * 5 + [pa.float64()]
            return [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]

        return score

    fields = (
        "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, chance double"
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > round(100 * MOST_REPEATED) * F.col("n_words")
    )
    return (
        map_texts(docs, make, fields)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("chance") >= LEAST_CHANCE))
    )
