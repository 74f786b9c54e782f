"""Trained operators on documents they have not learned from."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from casewise.llm.language_id import VOCABULARY, fit, languages, pieces, train
from casewise.llm import quality_rules
from casewise.llm.quality_rules import histogram
from casewise.llm.queries import QUERIES
from casewise.llm.textops import word_numbers
from casewise.llm.toxicity import Softmax, fit as fit_toxicity
from casewise.llm.training import calibrate

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def truth(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    return {r.doc_id: r for r in docs.join(labels, "doc_id", "left").collect()}


def _held_out(rows, modulus, rest):
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % modulus == rest)
        assert 0 <= row.score <= 1
    return [row for row in rows if row.held_out]


def _area(scores, labels):
    """The chance that a 1 scores above a 0."""
    ones = [s for s, x in zip(scores, labels, strict=True) if x]
    zeros = [s for s, x in zip(scores, labels, strict=True) if not x]
    return np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])


def test_quality_classifier(spark, truth):
    rows = _held_out(QUERIES["op1_quality_classifier"](spark, MEDIUM).collect(), 5, 0)
    known = [row for row in rows if truth[row.doc_id].quality is not None]
    assert all(row.predicted == (row.score >= 0.3) for row in rows)
    assert _area([r.score for r in known], [truth[r.doc_id].quality for r in known]) > 0.95
    assert np.mean([r.predicted == truth[r.doc_id].quality for r in known]) > 0.93


def test_toxicity(spark, truth):
    rows = _held_out(QUERIES["op8_toxicity"](spark, MEDIUM).collect(), 3, 1)
    known = [row for row in rows if truth[row.doc_id].toxic is not None]
    assert all(row.predicted == (row.score >= 0.7) for row in rows)
    assert _area([r.score for r in known], [truth[r.doc_id].toxic for r in known]) > 0.8


def test_language_id(spark, truth):
    rows = _held_out(QUERIES["op7_language_id"](spark, MEDIUM).collect(), 3, 1)
    right = [row.lang_pred == truth[row.doc_id].lang for row in rows]
    assert np.mean(right) > 0.97


def test_quality_rules(spark, truth):
    rows = QUERIES["op4_quality_rules"](spark, MEDIUM).collect()
    known = [row for row in rows if truth[row.doc_id].quality is not None and not row.base_failed]
    assert np.mean([r.kept for r in known if truth[r.doc_id].quality]) > 0.97
    bad = [r.kept for r in rows if truth[r.doc_id].quality == 0]
    assert np.mean(bad) < 0.15


def test_histogram_by_plain_loops():
    """Words, pairs and runs of four characters, not of bytes."""
    text = "größe é größe 𝄞x"
    words = [word.encode() for word in text.split()]
    ids, seen = word_numbers(words)
    found = histogram(text.encode(), ids, [*seen])
    place = lambda key: (key * 0x9E3779B97F4A7C15 % 2**64) >> (64 - quality_rules.BITS)
    prime, expected = 0x100000001B3, [Counter(), Counter()]
    keys = [zlib.crc32(word) for word in words]
    expected[0].update(place(key) for key in keys)
    expected[0].update(place((a * prime + b + 1) % 2**64) for a, b in zip(keys, keys[1:], strict=False))
    for at in range(len(text) - 3):
        key = 0
        for letter in text[at : at + 4]:
            key = (key * prime + ord(letter)) % 2**64
        expected[1][place(key)] += 1
    for half, counts in enumerate(expected):
        values = found[half * quality_rules._SIZE : (half + 1) * quality_rules._SIZE]
        assert {int(i) for i in np.flatnonzero(values)} == set(counts)
        total = sum(counts.values())
        assert all(values[i] == pytest.approx((n / total) ** 0.5, rel=1e-5) for i, n in counts.items())


def _segmentations(text, chance):
    """The summed chance of all segmentations, one by one."""
    if not text:
        return 1.0
    return sum(
        chance[text[:n]] * _segmentations(text[n:], chance)
        for n in range(1, len(text) + 1)
        if text[:n] in chance
    )


def test_forward_pass_sums_all_segmentations():
    import sentencepiece

    model = fit([("aa", b"the other thing then"), ("bb", b"das andere ding dann")])
    own = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    known = pieces(VOCABULARY)
    from casewise.llm.language_id import _codes, _hashes

    words = [b"other", b"dann", b"theta"]
    found = model.words(words)
    for column in range(2):
        chance = {}
        for i in range(own.get_piece_size()):
            text = own.id_to_piece(i)
            if own.is_byte(i) or own.is_control(i) or own.is_unknown(i):
                continue
            if all(letter in "▁otherdanta" for letter in text):
                place = int(known.find(_hashes(_codes([text]))[:, -1])[0])
                chance[text] = model.chances[place, column]
        for row, word in enumerate(words):
            expected = np.log(_segmentations("▁" + word.decode(), chance))
            assert found[row, column] == pytest.approx(expected, rel=1e-4)


def _full_sum(model, text):
    """Log chances of a word of any length: every letter's sum over all pieces that end there."""
    from casewise.llm.language_id import _codes, _hashes

    known = pieces(VOCABULARY)
    sums = [np.zeros(len(model.languages))]
    for stop in range(1, len(text) + 1):
        ways = []
        for start in range(stop):
            piece = int(known.find(_hashes(_codes([text[start:stop]]))[:, -1])[0])
            if piece < known.count or stop - start == 1:
                ways.append(sums[start] + np.log(model.chances[piece]))
        sums.append(np.logaddexp.reduce(ways, axis=0))
    return sums[-1]


@pytest.mark.parametrize("size", [23, 24, 25, 47, 48, 49, 150, 500])
def test_long_words_are_summed_whole(size):
    rng = np.random.default_rng(size)
    model = fit([("aa", b"the other thing then internationalisation"), ("bb", b"das andere ding dann")])
    word = "".join(rng.choice(list("theoranddingization"), size))
    assert model.words([word.encode()])[0] == pytest.approx(_full_sum(model, "▁" + word), rel=1e-5)


def test_every_language_is_learned(spark):
    """120 languages of which one has long texts only, one a single text, one most of all rows."""
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghiklmnoprstu"))
    rows, held = [], []
    for n in range(120):
        words = ["".join(rng.choice(letters, 6)) for _ in range(12)]
        count = 1 if n == 7 else 60 if n == 9 else 6
        for _ in range(count):
            size = 6_000 if n == 5 else 30
            rows.append((len(rows), " ".join(rng.choice(words, size)), f"l{n:03}"))
        held.append((10_000 + n, " ".join(rng.choice(words, 12)), None))
    docs = spark.createDataFrame(rows + held, "doc_id bigint, text string, lang string")
    model = train(docs, F.lit(True), texts=240)
    assert model.languages == [f"l{n:03}" for n in range(120)]
    found = {r.doc_id: r.lang_pred for r in languages(docs, model).where("doc_id >= 10000").collect()}
    assert np.mean([found[10_000 + n] == f"l{n:03}" for n in range(120)]) > 0.95
    assert found[10_005] == "l005" and found[10_007] == "l007"


def test_one_text_of_a_long_word(spark):
    docs = spark.createDataFrame(
        [(1, "the house and the dog", "en"), (2, "der hund und das haus", "de"), (3, "x" * 300_000, "en"), (4, "haus" * 50_000, None)],
        "doc_id bigint, text string, lang string",
    )
    found = {r.doc_id: r.lang_pred for r in languages(docs, train(docs, F.lit(True))).collect()}
    assert found[1] == "en" and found[4] == "de"


def test_misspellings_share_vectors():
    rng = np.random.default_rng(0)
    letters = np.array(list("abcdefghiklmnoprstu"))
    vocabulary = ["".join(rng.choice(letters, 5)).encode() for _ in range(400)]
    texts, labels = [], []
    for i in range(300):
        text = [vocabulary[int(j)] for j in rng.integers(0, len(vocabulary), 40)]
        if i % 4 == 0:
            text[int(rng.integers(0, 40))] = b"nastyword"
        texts.append(text)
        labels.append(int(i % 4 == 0))
    model = fit_toxicity(texts, np.array(labels))
    bad, near, fine = model.words([b"nastyword", b"nastywrod", vocabulary[3]])
    assert bad > near > fine
    plain = [vocabulary[int(j)] for j in rng.integers(0, len(vocabulary), 30)]
    assert model.text(model.words([*plain, b"nastyword"])) > 0.7
    assert model.text(model.words(plain)) < 0.5


def test_calibration_never_turns_the_order():
    margins = np.array([0.0, 1.0, 2.0, 3.0])
    assert calibrate(margins, np.array([1, 1, 0, 0]), True) == (1.0, 0.0)
    scale, shift = calibrate(margins, np.array([0, 0, 1, 1]), True)
    assert scale > 0 and scale * 0.5 + shift < 0 < scale * 2.5 + shift
    assert calibrate(np.zeros(4), np.array([0, 0, 1, 1]), False) == (1.0, 0.0)
    assert isinstance(fit_toxicity([], np.array([], int)), Softmax)
