"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (bytes, with marks at both ends) and of itself,
hashed to rows of an embedding table; its vector is the weighted mean of their rows. So a misspelling nobody
has seen shares most of its vector with the word it stands for. The vectors of a window of
a few words are averaged and a linear softmax tells the two labels apart; embeddings and
softmax are trained jointly.

Labels are of whole texts, toxicity is a matter of a word or two. Training therefore starts
with every window under its text's label, and in the later rounds keeps only the likeliest
window of a toxic text under it. A text's score is that of its most toxic window, so that a
long text does not dilute what it says.

The sample has at most ``ROWS`` toxic and ``CLEAN_ROWS`` other texts, trained on the driver;
a quarter of it only calibrates. As the
model is linear, a word's part in the softmax is one number; a worker remembers it.

Null and empty texts get the score of a window without evidence. Without labelled rows of
both labels every score is the smoothed share of label 1, 0.5 at no rows. Repeated rows are
scored each, an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewise.llm.textops import folded_words, map_texts, ranges
from casewise.llm.training import WordValues, calibrate, sampled_labels, sampled_texts

ROWS = 1500
CLEAN_ROWS = 4000
LONGEST = 20_000
THRESHOLD = 0.7
BUCKETS = 1 << 18
SIZES = (3, 4, 5, 6)
WHOLE = 0.2  # a word's own part in its vector
WIDTH = 8
WINDOW = 8
ROUNDS = 18
SETTLED = 3  # rounds in which every window of a toxic text counts as toxic
LEAST_STEPS = 1500
BATCH = 256
RATE = 0.5
EMBED_RATE = 30.0
DECAY = 1e-3

_ODD = np.uint64(0x9E3779B97F4A7C15)


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The rows of all subwords, word after word, and how many each word has."""
    marked = np.frombuffer(b"".join([b"<" + word + b">" for word in words]), np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.repeat(np.cumsum(lengths), lengths)
    owner, row = [], []
    word_of = np.repeat(np.arange(len(words)), lengths)
    key = np.zeros(len(marked), np.uint64)
    for size in range(1, max(SIZES) + 1):
        starts = len(marked) - size + 1
        if starts <= 0:
            break
        key = (key[:starts] + marked[size - 1 :].astype(np.uint64) + np.uint64(1)) * _ODD
        if size in SIZES:
            inside = np.flatnonzero(np.arange(starts) + size <= ends[:starts])
            mixed = key[inside] ^ (key[inside] >> np.uint64(31))
            row.append((mixed * _ODD >> np.uint64(40)).astype(np.int64) % BUCKETS)
            owner.append(word_of[inside])
    whole = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    row.append(((whole + np.uint64(1)) * _ODD >> np.uint64(40)).astype(np.int64) % BUCKETS)
    owner.append(np.arange(len(words)))
    owners, rows = np.concatenate(owner), np.concatenate(row)
    order = np.argsort(owners, kind="stable")
    return rows[order], np.bincount(owners, minlength=len(words))


def shares(counts: np.ndarray) -> np.ndarray:
    """What each row adds to its word; the word's own row is the last."""
    share = np.repeat((1 - WHOLE) / (counts - 1), counts)
    share[np.cumsum(counts) - 1] = WHOLE
    return share


@dataclass
class Softmax:
    """``bucket``: what each row adds to the difference of the two logits."""

    bucket: np.ndarray
    bias: float

    def words(self, words: list[bytes]) -> np.ndarray:
        rows, counts = subwords(words)
        firsts = np.cumsum(counts) - counts
        return np.add.reduceat(self.bucket[rows] * shares(counts), firsts).astype(np.float32)

    def logit(self, values: np.ndarray) -> float:
        """The logit of the likeliest window of a text, from its words' values."""
        if not len(values):
            return self.bias
        total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
        span = min(WINDOW, len(values))
        return float((total[span:] - total[:-span]).max()) / span + self.bias

    def text(self, values: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(values), -30, 30))))


def _windows(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and text of each window, cut side by side."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = -(-sizes // WINDOW)
    inside = ranges(np.zeros(len(texts), np.int64), counts) * WINDOW
    text = np.repeat(np.arange(len(texts)), counts)
    first = (np.cumsum(sizes) - sizes)[text] + inside
    return first, np.minimum(WINDOW, sizes[text] - inside), text


def _subword_table(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``subwords`` of many words in parts: rows, counts, and where each word's rows begin."""
    parts = [subwords(words[at : at + 50_000]) for at in range(0, len(words), 50_000)]
    rows = np.concatenate([part[0].astype(np.int32) for part in parts])
    counts = np.concatenate([part[1] for part in parts])
    return rows, counts, np.cumsum(counts) - counts


class _Trainer:
    """Embeddings, softmax and the sample's windows."""

    def __init__(self, texts: list[list[bytes]], rng: np.random.Generator):
        places: dict[bytes, int] = {}
        numbered = (places.setdefault(word, len(places)) for text in texts for word in text)
        self.ids = np.fromiter(numbered, np.int64, sum(map(len, texts)))
        self.rows, self.counts, self.firsts = _subword_table(list(places))
        self.start, self.length, self.text = _windows(texts)
        self.embed = rng.normal(0, 0.1, (BUCKETS, WIDTH))
        self.embed[~self._shared(texts)] = 0.0
        self.weight = rng.normal(0, 0.1, (WIDTH, 2))
        self.bias = np.zeros(2)

    def _parts(self):
        """The distinct words in slices, each with its rows, to bound what is expanded."""
        for at in range(0, len(self.counts), 50_000):
            words = slice(at, min(at + 50_000, len(self.counts)))
            stop = self.firsts[words.stop - 1] + self.counts[words.stop - 1]
            yield words, self.rows[self.firsts[at] : stop]

    def _shared(self, texts: list[list[bytes]]) -> np.ndarray:
        """The rows that more than one text has; the others could only tell that text."""
        owner = np.repeat(np.arange(len(texts)), [len(text) for text in texts])
        low = np.full(len(self.counts), len(texts))
        high = np.full(len(self.counts), -1)
        np.minimum.at(low, self.ids, owner)
        np.maximum.at(high, self.ids, owner)
        first, last = np.full(BUCKETS, len(texts)), np.full(BUCKETS, -1)
        for words, rows in self._parts():
            np.minimum.at(first, rows, np.repeat(low[words], self.counts[words]))
            np.maximum.at(last, rows, np.repeat(high[words], self.counts[words]))
        self.trained = first < last
        return self.trained

    def softmax(self) -> Softmax:
        gap = self.weight[:, 1] - self.weight[:, 0]
        return Softmax(self.embed @ gap, float(self.bias[1] - self.bias[0]))

    def chances(self) -> np.ndarray:
        """The chance of every window to be toxic, from its words' values."""
        model = self.softmax()
        values = np.concatenate(
            [
                np.add.reduceat(
                    model.bucket[rows] * shares(self.counts[words]),
                    self.firsts[words] - self.firsts[words.start],
                )
                for words, rows in self._parts()
            ]
        )
        total = np.add.reduceat(values[self.ids], self.start) / self.length
        return 1 / (1 + np.exp(-np.clip(total + model.bias, -30, 30)))

    def descend(self, chosen: np.ndarray, truth: np.ndarray, rate: float) -> None:
        """One step on some windows."""
        start, length = self.start[chosen], self.length[chosen]
        distinct, back = np.unique(self.ids[ranges(start, length)], return_inverse=True)
        counts = self.counts[distinct]
        parts = self.rows[ranges(self.firsts[distinct], counts)]
        cut = np.cumsum(counts) - counts
        share = shares(counts)
        vectors = np.add.reduceat(self.embed[parts] * share[:, None], cut)
        mean = np.add.reduceat(vectors[back], np.cumsum(length) - length) / length[:, None]
        logits = mean @ self.weight + self.bias
        wrong = 1 / (1 + np.exp(np.clip(logits[:, 0] - logits[:, 1], -30, 30))) - truth
        error = np.stack([-wrong, wrong], 1)
        spread = np.repeat((error @ self.weight.T) / length[:, None], length, axis=0)
        touched, slot = np.unique(parts, return_inverse=True)
        slope = np.empty((len(touched), WIDTH))
        for d in range(WIDTH):
            per_word = np.bincount(back, spread[:, d], len(distinct))
            slope[:, d] = np.bincount(slot, np.repeat(per_word, counts) * share, len(touched))
        slope[~self.trained[touched]] = 0.0
        self.embed[touched] -= rate * (EMBED_RATE * slope + DECAY * self.embed[touched])
        self.weight -= rate * (mean.T @ error) / len(chosen)
        self.bias -= rate * error.sum(0) / len(chosen)


def fit(texts: list[list[bytes]], labels: np.ndarray, seed: int = 7) -> Softmax:
    """Joint training on three quarters of the texts, calibration on the last."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    flat = Softmax(np.zeros(BUCKETS), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    part = rng.permutation(len(texts)) % 4
    learnt = [i for i in np.flatnonzero(part).tolist() if texts[i]]
    toxic = labels[learnt] == 1
    if not toxic.any() or toxic.all():
        return flat
    trainer = _Trainer([texts[i] for i in learnt], rng)
    text, suspect = trainer.text, toxic[trainer.text]
    # Small samples take more rounds, so that every sample is met in as many steps.
    rounds = max(ROUNDS, -(-LEAST_STEPS // (2 * int(suspect.sum()) // BATCH + 1)))
    for step in range(rounds):
        if step * ROUNDS < SETTLED * rounds:
            # Every window of a toxic text is toxic; as many others.
            truth = suspect.copy()
            sampled = rng.random(len(text)) < max(0.05, suspect.mean())
            used = suspect | sampled
        else:
            # The likeliest window of a toxic text is; what is unlikely is not.
            chance = trainer.chances()
            best = np.zeros(len(learnt))
            np.maximum.at(best, text, chance)
            truth = suspect & (chance >= best[text])
            doubtful = suspect & ~truth & (chance >= 0.5)
            hard = ~suspect & (chance > 0.02)
            used = truth | ((hard | (rng.random(len(text)) < 0.2)) & ~doubtful)
        order = rng.permutation(np.flatnonzero(used))
        for chosen in np.array_split(order, len(order) // BATCH + 1):
            chosen = np.sort(chosen)
            trainer.descend(chosen, truth[chosen].astype(float), RATE * (1 - step / rounds))
    model = trainer.softmax()
    held = np.flatnonzero(part == 0).tolist()
    return _calibrated(model, [texts[i] for i in held], labels[held])


def _calibrated(model: Softmax, texts: list[list[bytes]], labels: np.ndarray) -> Softmax:
    """Scale and bias by which the likeliest window's chance is that of the text's label."""
    logits = np.array([model.logit(model.words(text) if text else np.empty(0)) for text in texts])
    scale, shift = calibrate(logits, labels, balanced=True)
    return Softmax(model.bucket * scale, model.bias * scale + shift)


def train(
    docs: DataFrame,
    labels: DataFrame,
    allowed: Column,
    rows: int = ROWS,
    clean_rows: int = CLEAN_ROWS,
) -> Softmax:
    """A model from a bounded number of labelled texts whose ``doc_id`` is ``allowed``."""
    toxic = F.col("toxic") == 1
    chosen = sampled_labels(labels, "toxic", allowed & toxic, rows).unionByName(
        sampled_labels(labels, "toxic", allowed & ~toxic, clean_rows)
    )
    found = sampled_texts(docs, chosen, LONGEST).toArrow()
    order = np.argsort(found["doc_id"].to_numpy())
    texts = found["text"].cast(pa.binary()).take(pa.array(order)).to_pylist()
    return fit([folded_words(text) for text in texts], found["label"].to_numpy()[order])


def scores(docs: DataFrame, model: Softmax) -> DataFrame:
    """``doc_id`` and ``score`` of every row."""

    def make():
        known = WordValues(model.words)

        def score(texts: list[bytes]) -> list[pa.Array]:
            words = [folded_words(text) for text in texts]
            values = known.of(words)
            ends = np.cumsum([len(one) for one in words]).tolist()
            starts = [0, *ends]
            return [pa.array([model.text(values[a:b]) for a, b in zip(starts, ends, strict=False)])]

        return score

    return map_texts(docs, make, "score double")
