"""Bounded samples to train on, and word values that a worker remembers."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(modulus: int) -> Column:
    """crc32 of the document id as text, modulo ``modulus``; -1 without an id."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % modulus, F.lit(-1))


def sampled_labels(labels: DataFrame, label: str, allowed: Column, rows: int) -> DataFrame:
    """``doc_id`` and ``label`` (0 or 1) of at most ``rows`` labelled documents.

    They are the first in the order of the hashed id, so the choice depends neither on the
    order of the rows nor on their partitions. Contradicting labels of one document count
    as their rounded mean.
    """
    voted = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & allowed)
        .groupBy("doc_id")
        .agg(F.round(F.avg("label")).cast("int").alias("label"))
    )
    return voted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def sampled_texts(docs: DataFrame, chosen: DataFrame, longest: int, named: str = "label"):
    """``doc_id``, the ``named`` column and ``text`` of the ``chosen`` documents, one row each.

    ``chosen`` is a sample of bounded size, so it may be broadcast. Documents of more than
    ``longest`` characters are not trained on; so the sample's bytes are bounded too. Of
    documents that share an id, the one with the smallest hash is taken.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    texts = texts.where(F.length("text") <= longest)
    found = texts.join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(
        F.max(named).alias(named), F.min_by("text", F.xxhash64("text")).alias("text")
    )


def fold_of(doc_ids: np.ndarray, parts: int) -> np.ndarray:
    """A part for each training row, by its id."""
    mixed = doc_ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)) % np.uint64(parts)


def calibrate(margins: np.ndarray, labels: np.ndarray, balanced: bool) -> tuple[float, float]:
    """Scale and shift of a logistic curve through held-back margins.

    Newton's method on standardised margins, each step halved until it helps. ``balanced``
    gives both labels the same weight in sum. Where the curve would fall, or there is
    nothing to go by, the margins stay as they are.
    """
    ones, zeros = labels.sum(), (1 - labels).sum()
    spread = margins.std() if len(margins) else 0.0
    if not ones or not zeros or not spread > 0:
        return 1.0, 0.0
    aim = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    share = np.where(labels == 1, 0.5 / ones, 0.5 / zeros) * len(labels)
    weight = share if balanced else np.ones(len(labels))
    centre = margins.mean()
    inputs = np.stack([(margins - centre) / spread, np.ones(len(margins))], 1)

    def loss(at: np.ndarray) -> float:
        logits = inputs @ at
        return float((weight * (np.logaddexp(0, logits) - aim * logits)).sum() + 0.01 * at @ at)

    at, now = np.zeros(2), np.inf
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ at, -30, 30)))
        slope = inputs.T @ (weight * (aim - chance)) - 0.02 * at
        curve = (inputs * (weight * chance * (1 - chance))[:, None]).T @ inputs
        step = np.linalg.solve(curve + 0.02 * np.eye(2), slope)
        while loss(at + step) > now and np.abs(step).max() > 1e-9:
            step /= 2
        at, before = at + step, now
        now = loss(at)
        if before - now < 1e-9:
            break
    if at[0] <= 0:
        return 1.0, 0.0
    return float(at[0] / spread), float(at[1] - at[0] * centre / spread)


_WORD_BYTES = 32 << 20


class WordValues:
    """Values of words, worked out once per distinct word while they fit.

    ``value`` maps distinct words to an array with a row for each. No more than ``limit``
    words, of ``_WORD_BYTES`` in all, are remembered; then the table starts afresh.
    """

    def __init__(self, value: Callable[[list[bytes]], np.ndarray], limit: int = 400_000):
        self.value, self.limit = value, limit
        self.places: dict[bytes, int] = {}
        self.held = 0
        self.table: np.ndarray | None = None

    def of(self, texts: list[list[bytes]]) -> np.ndarray:
        """The values of all words of all texts, one after the other."""
        distinct = set().union(*texts)
        new = list(distinct.difference(self.places))
        if len(self.places) + len(new) > self.limit or self.held > _WORD_BYTES:
            self.places, self.table, self.held, new = {}, None, 0, list(distinct)
        if new:
            values = self.value(new)
            start = len(self.places)
            self.held += sum(map(len, new))
            self.places.update(zip(new, range(start, start + len(new)), strict=True))
            self.table = values if self.table is None else np.concatenate([self.table, values])
        if self.table is None:
            self.table = self.value([b"a"])[:0]
        count = sum(map(len, texts))
        return self.table[
            np.fromiter(map(self.places.__getitem__, chain.from_iterable(texts)), np.int64, count)
        ]
