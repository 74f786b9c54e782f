"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature is cut into bins. Boosting visits the features in turn, again and again, and
each time fits a tree of a few leaves to what is left, on that feature alone; the sum of a
feature's trees is its lookup table. The pairs of features that explain most of the rest
get tables of two dimensions in the same way. A score is the sum of the tables at the
text's bins, through the logistic function.

The model is trained on the driver from the features of a sample of at most ``ROWS``
labelled texts. Scoring is row-local: features of the whole text, then additions.

Null and empty texts have the features of a text without words and get a score as well.
Without labelled rows, or with labels of one kind, the score is the smoothed share of label
1, 0.5 at no rows. Repeated rows are scored each, an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewise.llm.textops import map_texts, small_batches, text_value, word_numbers
from casewise.llm.training import sampled_labels, sampled_texts

ROWS = 12_000
LONGEST = 100_000
THRESHOLD = 0.3
BINS = 32
PAIR_BINS = 8
PAIRS = 8
ROUNDS = 60
RATE = 0.15

FEATURES = (
    "words", "word_length", "word_spread", "distinct", "top_word", "stutter", "pairs_again",
    "triples_again", "upper", "digits", "symbols", "marks", "exclaims", "pipes", "stops",
    "beyond_ascii", "short_words", "lines_again", "line_words", "spaces",
)


def _byte_classes() -> np.ndarray:
    """For each byte its class: 0 other, then upper, lower, digits, symbols, marks, !, |, stop,
    beyond ASCII, space, line end."""
    classes = np.zeros(256, np.int64)
    classes[[*b"'\"()[]{}+-_=/\\@~^`:;,?"]] = 5
    classes[ord("A") : ord("Z") + 1], classes[ord("a") : ord("z") + 1] = 1, 2
    classes[ord("0") : ord("9") + 1] = 3
    classes[[*b"#*$%&<>"]] = 4
    classes[ord("!")], classes[ord("|")], classes[ord(".")] = 6, 7, 8
    classes[0x80:] = 9
    classes[[*b" \t"]], classes[[*b"\n\r\v\f"]] = 10, 11
    return classes


_CLASSES = _byte_classes()


def features(text: bytes) -> list[float]:
    """What ``FEATURES`` names, of one text."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    ids, seen = word_numbers(words)
    lengths = np.fromiter(map(len, seen), np.int64, len(seen))
    counts = np.bincount(ids)
    mean = float(lengths @ counts) / n
    spread = float((lengths - mean) ** 2 @ counts) / n
    pairs = ids[:-1] * len(seen) + ids[1:]
    triples = ids[:-2] * (len(seen) + 1) * 1_000_003 + ids[1:-1] * 1_000_003 + ids[2:]
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = np.bincount(_CLASSES, by_byte, minlength=12)
    size, letters = len(text), max(1.0, kinds[1] + kinds[2])
    lines = [line for line in text.split(b"\n") if line.strip()]
    return [
        float(np.log1p(n)),
        mean,
        spread**0.5,
        len(seen) / n,
        counts.max() / n,
        float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0.0,
        1 - len(np.unique(pairs)) / len(pairs) if n > 1 else 0.0,
        1 - len(np.unique(triples)) / len(triples) if n > 2 else 0.0,
        kinds[1] / letters,
        kinds[3] / size,
        kinds[4] / size,
        kinds[5] / size,
        kinds[6] / n,
        kinds[7] / n,
        kinds[8] / n,
        kinds[9] / size,
        float(counts[lengths <= 3].sum()) / n,
        1 - len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        (kinds[10] + kinds[11]) / size,
    ]


@dataclass
class Additive:
    """Bin edges and tables; ``pairs`` holds the features of each table of two dimensions."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, values: np.ndarray) -> np.ndarray:
        total = np.full(len(values), self.base)
        for column, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, values[:, column], "right")]
        bins = [
            np.searchsorted(edges, values[:, column], "right")
            for column, edges in enumerate(self.coarse)
        ]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[bins[a], bins[b]]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(gradient: float, hessian: float) -> float:
    return gradient / (hessian + 1.0)


def _gain(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    return gradient**2 / (hessian + 1.0)


def _cut(gradient: np.ndarray, hessian: np.ndarray) -> tuple[float, int]:
    """The best place to cut a run of bins in two, and what it gains."""
    if len(gradient) < 2:
        return 0.0, 0
    g, h = np.cumsum(gradient), np.cumsum(hessian)
    gains = _gain(g[:-1], h[:-1]) + _gain(g[-1] - g[:-1], h[-1] - h[:-1]) - _gain(g[-1], h[-1])
    best = int(gains.argmax())
    return float(gains[best]), best + 1


def _shallow(gradient: np.ndarray, hessian: np.ndarray, leaves: int = 4) -> np.ndarray:
    """A tree over ordered bins, grown where it gains most; its value at every bin."""
    parts = [(0, len(gradient))]
    while len(parts) < leaves:
        cuts = [_cut(gradient[a:b], hessian[a:b]) for a, b in parts]
        place = max(range(len(parts)), key=lambda i: cuts[i][0])
        if cuts[place][0] <= 1e-9:
            break
        a, b = parts[place]
        parts[place : place + 1] = [(a, a + cuts[place][1]), (a + cuts[place][1], b)]
    values = np.zeros(len(gradient))
    for a, b in parts:
        values[a:b] = _leaf(gradient[a:b].sum(), hessian[a:b].sum())
    return values


def _shallow_pair(gradient: np.ndarray, hessian: np.ndarray) -> tuple[float, np.ndarray]:
    """A tree that cuts one feature and then each side by the other; gain and values."""
    best_gain, best = 0.0, np.zeros_like(gradient)
    for turned in (False, True):
        g, h = (gradient.T, hessian.T) if turned else (gradient, hessian)
        for cut in range(1, len(g)):
            values, gain = np.zeros_like(g), -float(_gain(g.sum(), h.sum()))
            for rows in (slice(0, cut), slice(cut, None)):
                gs, hs = g[rows].sum(0), h[rows].sum(0)
                more, at = _cut(gs, hs)
                gain += more + float(_gain(gs.sum(), hs.sum()))
                values[rows, :at] = _leaf(gs[:at].sum(), hs[:at].sum())
                values[rows, at:] = _leaf(gs[at:].sum(), hs[at:].sum())
            if gain > best_gain:
                best_gain, best = gain, values.T if turned else values
    return best_gain, best


def fit(values: np.ndarray, labels: np.ndarray) -> Additive:
    """Cyclic boosting of the single features, then of the pairs that gain most."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    model = Additive(float(np.log(share / (1 - share))))
    if len(labels) < 2 or labels.min() == labels.max():
        return model
    columns = range(values.shape[1])
    model.edges = [_edges(values[:, c], BINS) for c in columns]
    model.coarse = [_edges(values[:, c], PAIR_BINS) for c in columns]
    fine = [np.searchsorted(model.edges[c], values[:, c], "right") for c in columns]
    broad = [np.searchsorted(model.coarse[c], values[:, c], "right") for c in columns]
    model.tables = [np.zeros(len(edges) + 1) for edges in model.edges]
    total = np.full(len(labels), model.base)

    def left() -> tuple[np.ndarray, np.ndarray]:
        chance = 1 / (1 + np.exp(-total))
        return labels - chance, chance * (1 - chance)

    for _ in range(ROUNDS):
        for c in columns:
            gradient, hessian = left()
            size = len(model.tables[c])
            tree = _shallow(
                np.bincount(fine[c], gradient, size), np.bincount(fine[c], hessian, size)
            )
            model.tables[c] += RATE * tree
            total += RATE * tree[fine[c]]

    def grids(a: int, b: int) -> list[np.ndarray]:
        shape = len(model.coarse[a]) + 1, len(model.coarse[b]) + 1
        place = broad[a] * shape[1] + broad[b]
        size = shape[0] * shape[1]
        return [np.bincount(place, part, size).reshape(shape) for part in left()]

    gains = {pair: _shallow_pair(*grids(*pair))[0] for pair in combinations(columns, 2)}
    model.pairs = sorted(gains, key=lambda pair: -gains[pair])[:PAIRS]
    model.pair_tables = [
        np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)) for a, b in model.pairs
    ]
    for _ in range(ROUNDS // 3):
        for table, (a, b) in zip(model.pair_tables, model.pairs, strict=True):
            tree = _shallow_pair(*grids(a, b))[1]
            table += RATE * tree
            total += RATE * tree[broad[a], broad[b]]
    return model


def train(docs: DataFrame, labels: DataFrame, allowed: Column, rows: int = ROWS) -> Additive:
    """A model from at most ``rows`` labelled texts whose ``doc_id`` is ``allowed``."""
    chosen = sampled_labels(labels, "quality", allowed, rows)
    texts = sampled_texts(docs, chosen, LONGEST)

    def make():
        def score(texts: list[bytes]) -> list[pa.Array]:
            return [pa.array([features(text) for text in texts], pa.list_(pa.float64()))]

        return score

    found = map_texts(texts, make, "f array<double>", keep=("doc_id", "label")).toArrow()
    order = np.argsort(found["doc_id"].to_numpy())
    values = np.array(found["f"].to_pylist(), float).reshape(-1, len(FEATURES))[order]
    return fit(values, found["label"].to_numpy()[order].astype(float))


def _scorer(model: Additive):
    def score(texts: list[bytes]) -> list[pa.Array]:
        values = np.array([features(text) for text in texts], float)
        return [pa.array(model.score(values.reshape(-1, len(FEATURES))))]

    return score


def scores(docs: DataFrame, model: Additive) -> DataFrame:
    """``doc_id`` and ``score`` of every row."""
    return map_texts(docs, lambda: _scorer(model), "score double")


def keep_good(docs: DataFrame, model: Additive, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``."""
    small_batches(docs.sparkSession)
    score = text_value(lambda: _scorer(model), "double")
    return docs.where(score(F.col("text").cast("string")) >= threshold)
