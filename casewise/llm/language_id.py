"""Language identification by unigrams whose segmentation is summed out.

Each language has a probability for every piece of a fixed public vocabulary. The chance
of a word is the sum over all its segmentations into pieces, which a forward pass over the
word's letters gives; the score of a text is the product over its words. The probabilities
are fitted by expectation maximisation: forward and backward passes count the pieces of all
segmentations by their chance.

Words are runs of letters and of anything beyond ASCII, lower-cased. No piece crosses
words, so a text's score needs each distinct word once; a worker remembers them. A word of
any length is summed over all its segmentations: one of more than ``LONGEST_WORD`` letters in
strips of that many. What a strip does to the sums is a small matrix, made for many strips at
once; one after the other they are applied to the sums of the strip before, so that texts
without spaces cost their length.

Every language is learned. The sample is trained on the driver: it has at most ``TEXTS`` texts
in all, shared evenly by the languages, at most ``ROWS`` and at least one of each, none longer
than ``LONGEST`` characters; a language of longer texts only is learned from its shortest.
In the sample long words count as their strips. A language takes 128 KB of the model.

Null texts and texts without a letter are ``und`` with score 0. If no language was learned,
every text is ``und``. Of languages that fit equally well the first by name is taken.
Repeated rows are labelled each, an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from casewise.llm.textops import fold, map_texts
from casewise.llm.training import WordValues

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
ROWS = 250
TEXTS = 12_000
LONGEST = 20_000
ROUNDS = 4
LONGEST_WORD = 24
UNKNOWN = 1e-8  # chance of a letter that no piece covers
PRIOR = 0.01  # count that every piece starts with
SHARPNESS = 0.2  # of the score: how much of each word's evidence counts

_START = "▁"
_NO_LETTERS = bytes(0x20 if 0x30 <= byte <= 0x39 else byte for byte in range(256))
_BASE = np.uint64(0x100000001B3)


def letter_words(text: bytes) -> list[bytes]:
    """Runs of letters and bytes beyond ASCII, A-Z lower-cased."""
    return fold(text).translate(_NO_LETTERS).split()


def has_letter(text: bytes) -> bool:
    if re.search(rb"[A-Za-z]", text):
        return True
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


def _hashes(codes: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes of the rows of ``codes``."""
    out = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    for place in range(codes.shape[1]):
        out[:, place + 1] = out[:, place] * _BASE + codes[:, place].astype(np.uint64)
    return out


class Pieces:
    """The vocabulary's pieces, found by hash in many words at once."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = (model.is_control, model.is_unknown, model.is_byte)
        texts = sorted(
            {model.id_to_piece(i) for i in ids if not any(check(i) for check in special)}
        )
        keys = np.array([_hashes(_codes([text]))[0, -1] for text in texts], np.uint64)
        self.count, self.longest = len(texts), max(map(len, texts))
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The piece of each key, ``count`` where there is none."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.order[at], self.count)


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length."""
    joined = np.frombuffer("".join(words).encode("utf-32-le", "replace"), np.uint32)
    return joined.reshape(len(words), -1)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _marked(word: bytes) -> str:
    return _START + word.decode("utf-8", "replace").lower()


def _by_length(words: list[str], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points of the marked words, cut where too long, in groups of one length and at most
    ``rows`` rows; with the place in ``words`` of each row."""
    groups: dict[int, tuple[list[str], list[int]]] = {}
    for place, text in enumerate(words):
        for at in range(0, len(text), LONGEST_WORD):
            part = text[at : at + LONGEST_WORD]
            texts, places = groups.setdefault(len(part), ([], []))
            texts.append(part)
            places.append(place)
    for texts, places in groups.values():
        codes, owners = _codes(texts), np.array(places)
        for at in range(0, len(codes), rows):
            yield codes[at : at + rows], owners[at : at + rows]


def _lattice(vocabulary: Pieces, codes: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
    """For each stretch of the words, the piece that spans it."""
    prefix, size = _hashes(codes), codes.shape[1]
    power = np.cumprod(np.append(np.uint64(1), np.full(size, _BASE)))
    found = {}
    for stop in range(1, size + 1):
        for start in range(max(0, stop - vocabulary.longest), stop):
            part = vocabulary.find(prefix[:, stop] - prefix[:, start] * power[stop - start])
            if stop - start == 1 or (part < vocabulary.count).any():
                found[start, stop] = part
    return found


def _forward(lattice, chances: np.ndarray, rows: int, size: int) -> np.ndarray:
    """Per word, place and language the summed chance of all ways to get there."""
    alpha = np.zeros((size + 1, rows, chances.shape[1]))
    alpha[0] = 1.0
    for (start, stop), part in lattice.items():
        alpha[stop] += alpha[start] * _chance(chances, part, stop - start)
    return alpha


def _chance(chances: np.ndarray, part: np.ndarray, length: int) -> np.ndarray:
    """``chances`` has one row more than there are pieces: for a letter without a piece."""
    found = chances[part]
    if length > 1:
        found[part == len(chances) - 1] = 0.0
    return found


def _strips(vocabulary: Pieces, chances: np.ndarray, codes: np.ndarray) -> Iterator[np.ndarray]:
    """For each strip of ``LONGEST_WORD`` letters the sums at its last places, for a way that begins
    at each of the last places of the strip before: an array by last place, language, first place.

    A row of ``codes`` has the letters of a strip behind those that a piece may begin in.
    """
    reach, languages = vocabulary.longest, chances.shape[1]
    rows = max(1, 4_000 // max(1, languages))
    for at in range(0, len(codes), rows):
        part = codes[at : at + rows]
        sums = np.zeros((part.shape[1] + 1, len(part), languages, reach))
        for place in range(reach):
            sums[place, :, :, place] = 1.0
        for (start, stop), piece in _lattice(vocabulary, part).items():
            if stop >= reach:
                sums[stop] += sums[start] * _chance(chances, piece, stop - start)[:, :, None]
        yield from sums[-reach:].transpose(1, 0, 2, 3)


def _long_word(vocabulary: Pieces, chances: np.ndarray, text: str) -> np.ndarray:
    """The log chance of a word of more than ``LONGEST_WORD`` letters in each language."""
    reach, codes = vocabulary.longest, _codes([text])
    head = codes.shape[1] % LONGEST_WORD or LONGEST_WORD
    alpha = _forward(_lattice(vocabulary, codes[:, :head]), chances, 1, head)[:, 0]
    state = np.zeros((reach, chances.shape[1]))
    state[-min(reach, head + 1) :] = alpha[-reach:]
    # Letters before the word: no way begins there.
    padded = np.concatenate([np.zeros(reach, codes.dtype), codes[0]])
    begins = np.arange(head, codes.shape[1], LONGEST_WORD)
    spans = np.lib.stride_tricks.sliding_window_view(padded, reach - 1 + LONGEST_WORD)[begins + 1]
    log = np.zeros(chances.shape[1])
    for sums in _strips(vocabulary, chances, spans):
        state = np.einsum("oli,il->ol", sums, state)
        scale = state.max(0)
        state /= scale
        log += np.log(scale)
    return log + np.log(state[-1])


def _rows(languages: int) -> int:
    """Words to work on at once, so that a forward pass stays within some megabytes."""
    return max(500, 80_000 // max(1, languages))


@dataclass
class Unigrams:
    """Piece chances by language; the last row is that of an unknown letter."""

    vocabulary: str
    languages: list[str]
    chances: np.ndarray

    def words(self, words: list[bytes]) -> np.ndarray:
        """The log chance of each word in each language."""
        total = np.zeros((len(words), len(self.languages)), np.float32)
        known, marked = pieces(self.vocabulary), [_marked(word) for word in words]
        whole = [place for place, text in enumerate(marked) if len(text) <= LONGEST_WORD]
        for codes, places in _by_length([marked[i] for i in whole], _rows(len(self.languages))):
            alpha = _forward(_lattice(known, codes), self.chances, *codes.shape)
            total[np.array(whole)[places]] = np.log(alpha[-1])
        for place, text in enumerate(marked):
            if len(text) > LONGEST_WORD:
                total[place] = _long_word(known, self.chances, text)
        return total


def fit(texts: list[tuple[str, bytes]], vocabulary: str = VOCABULARY) -> Unigrams:
    """Piece chances from ``(language, text)`` rows."""
    languages = sorted({language for language, _ in texts})
    known = pieces(vocabulary)
    chances = np.full((known.count + 1, len(languages)), 1 / known.count)
    chances[-1] = UNKNOWN
    places: dict[bytes, int] = {}
    counted: dict[tuple[int, int], int] = {}
    columns = {language: column for column, language in enumerate(languages)}
    for language, text in texts:
        column = columns[language]
        for word in letter_words(text):
            key = places.setdefault(word, len(places)), column
            counted[key] = counted.get(key, 0) + 1
    counts = np.zeros((len(places), len(languages)))
    for (row, column), count in counted.items():
        counts[row, column] = count
    groups = [
        (_lattice(known, codes), counts[rows], codes.shape)
        for codes, rows in _by_length([*map(_marked, places)], _rows(len(languages)))
    ]
    for _ in range(ROUNDS):
        seen = np.full_like(chances, PRIOR)
        for lattice, count, (rows, size) in groups:
            alpha = _forward(lattice, chances, rows, size)
            beta = np.zeros_like(alpha)
            beta[-1] = count / alpha[-1]
            for (start, stop), part in reversed(lattice.items()):
                flow = beta[stop] * _chance(chances, part, stop - start)
                beta[start] += flow
                flow = flow * alpha[start]
                for column in range(len(languages)):
                    seen[:, column] += np.bincount(part, flow[:, column], len(seen))
        chances = seen / seen[:-1].sum(0)
        chances[-1] = UNKNOWN
    return Unigrams(vocabulary, languages, chances)


def train(
    docs: DataFrame,
    allowed: Column,
    rows: int = ROWS,
    vocabulary: str = VOCABULARY,
    texts: int = TEXTS,
    longest: int = LONGEST,
) -> Unigrams:
    """A model of all languages, from at most ``rows`` texts of each whose ``doc_id`` is ``allowed``."""
    size = F.length("text").alias("size")
    named = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), size).where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("size").isNotNull() & allowed
    )
    share = max(1, min(rows, texts // max(1, named.select("lang").distinct().count())))
    long = F.col("size") > longest
    order = Window.partitionBy("lang").orderBy(
        long, F.when(long, F.col("size")), F.xxhash64("doc_id"), "doc_id", "size"
    )
    chosen = (
        named.withColumn("place", F.row_number().over(order))
        .where((F.col("place") <= share) & (~long | (F.col("place") == 1)))
        .groupBy("doc_id", "lang", "size")
        .agg(F.min("place").alias("place"))
    )
    whole = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), size)
    # As many rows as the sample has, of a few words each.
    found = whole.join(F.broadcast(chosen), ["doc_id", "lang", "size"])
    found = found.groupBy("doc_id", "lang", "size").agg(F.min_by("text", F.xxhash64("text")).alias("text")).toArrow()
    pairs = zip(
        found["lang"].to_pylist(), found["text"].cast(pa.binary()).to_pylist(), strict=True
    )
    return fit(sorted(pairs), vocabulary)


def languages(docs: DataFrame, model: Unigrams) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row."""

    def make():
        # A value for each word and language, some megabytes in all.
        known = WordValues(model.words, limit=max(4_000, 1_000_000 // max(1, len(model.languages))))

        def score(texts: list[bytes]) -> list[pa.Array]:
            words = [letter_words(text) for text in texts]
            values = known.of(words)
            names, chances, at = [], [], 0
            for text, own in zip(texts, words, strict=True):
                total = values[at : at + len(own)].sum(0, dtype=np.float64)
                at += len(own)
                if not model.languages or not has_letter(text):
                    names.append("und")
                    chances.append(0.0)
                    continue
                best = int(total.argmax())
                share = np.exp((total - total[best]) * SHARPNESS)
                names.append(model.languages[best])
                chances.append(float(1 / share.sum()))
            return [pa.array(names, pa.string()), pa.array(chances, pa.float64())]

        return score

    return map_texts(docs, make, "lang_pred string, score double")
