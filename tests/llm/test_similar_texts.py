"""Similar texts against all pairs."""

from __future__ import annotations

import corpus_pipeline
import numpy as np

from casewise.llm import similar_texts
from casewise.llm.similar_texts import drop_similar, shingles, similarity, sketch
from casewise.llm.textops import read_table
from similar_pairs import firsts_of_similar

SMALL = "/root/testdata/sf0.001"


def test_stage_keeps_one_of_each(spark, documents):
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    kept = stage(spark, read_table(spark, SMALL, "documents"), SMALL).collect()
    assert sorted(row.doc_id for row in kept) == sorted(firsts_of_similar(documents))
    assert all(row.text == documents[row.doc_id] for row in kept)


def test_near_copies_above_the_limit_only(spark):
    words = [f"w{i * 7919 % 1000}" for i in range(104)]  # 100 shingles
    texts = {1: " ".join(words)}
    texts[2] = " ".join([*words[:-10], *(f"x{i}" for i in range(10))])  # 90 common of 110
    texts[3] = " ".join([*words[:50], "y", *words[51:]])  # 95 common of 105
    texts[4] = " ".join([*(f"z{i}" for i in range(12)), *words[12:]])  # 88 common of 112
    texts |= {5: "few words", 6: "Few  words", 7: "few other", 8: "", 9: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {row.doc_id for row in drop_similar(docs).collect()} == firsts_of_similar(texts) == {1, 4, 5, 7, 8}


def test_large_group(spark):
    """Many different near copies of one text, none of them compared with all others."""
    words = [f"w{i * 7919 % 1000}" for i in range(204)]
    texts = {n: " ".join([*words[:n], f"x{n}", *words[n + 1 :]]) for n in range(200)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert [row.doc_id for row in drop_similar(docs).collect()] == [0]


def test_recall_on_planted_pairs(spark):
    """1,500 pairs of a similarity from 0.8 to 0.98, each in a component of its own."""
    rng = np.random.default_rng(11)
    docs = []
    for pair in range(1_500):
        words = [f"p{pair}w{i}" for i in rng.permutation(260)]
        changes = int(rng.integers(1, 6))  # each replaces five shingles of 256
        other = list(words)
        for place in range(changes):
            other[20 + 45 * place] = f"p{pair}x{place}"
        docs += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(other))]
    grams = [shingles(text.encode()) for _, text in docs]
    alike = [similarity(a, b) >= 0.8 for a, b in zip(grams[::2], grams[1::2], strict=True)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    kept = {row.doc_id for row in drop_similar(table).select("doc_id").collect()}
    found = [2 * pair + 1 not in kept for pair in range(1_500)]
    assert all(not f for f, a in zip(found, alike, strict=True) if not a)
    recall = sum(f for f, a in zip(found, alike, strict=True) if a) / sum(alike)
    assert sum(alike) > 1_000 and recall > 0.999


def test_recall_on_planted_families(spark):
    """250 families of eight texts, each made of another one of its family: components against all pairs."""
    rng = np.random.default_rng(12)
    families, docs = [], []
    for family in range(250):
        words = [f"f{family}w{i}" for i in range(260)]
        texts = [words]
        for copy in range(1, 8):
            other = list(texts[int(rng.integers(0, copy))])
            for place in rng.choice(260, int(rng.integers(1, 5)), replace=False):
                other[place] = f"f{family}c{copy}x{place}"
            texts.append(other)
        families.append({8 * family + n: " ".join(text) for n, text in enumerate(texts)})
        docs += families[-1].items()
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    kept = {row.doc_id for row in drop_similar(table).select("doc_id").collect()}
    right = sum(kept & set(family) == firsts_of_similar(family) for family in families)
    assert right >= 248


def test_the_stage_links_by_simhash(spark, monkeypatch):
    """Without any MinHash key, pairs whose fingerprints differ in few bits are still found, and
    are links only if the texts are similar."""
    monkeypatch.setattr(similar_texts, "sketch", lambda grams: (*sketch(grams)[:2], []))
    words = [f"w{i * 7919 % 4000}" for i in range(2_000)]
    texts = {1: " ".join(words), 2: " ".join([*words[:1999], "x"]), 3: " ".join(words[:30]), 4: "", 5: "other"}
    assert (sketch(shingles(texts[1].encode()))[1] ^ sketch(shingles(texts[2].encode()))[1]).bit_count() <= 2
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {row.doc_id for row in corpus_pipeline.one_of_each(spark, docs, SMALL).collect()} == {1, 3, 4, 5}


def test_equal_fingerprints_are_no_links_by_themselves(spark, monkeypatch):
    monkeypatch.setattr(similar_texts, "sketch", lambda grams: (sketch(grams)[0], 7, []))
    docs = [(i, f"a{i} b{i} c{i} d{i} e{i} f{i}") for i in range(30)] + [(30, "A0 b0 c0 d0  e0 f0")]
    kept = drop_similar(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert sorted(row.doc_id for row in kept.collect()) == list(range(30))


def _chain():
    """Five texts: the second one is similar to the third only, the first to none, the fourth to the fifth only."""
    words = [[f"{family}w{i}" for i in range(60)] for family in "abc"]
    return {
        1: " ".join(words[0]),
        2: " ".join(words[1]),
        3: " ".join([*words[1][:59], "x"]),
        4: " ".join(words[2]),
        5: " ".join([*words[2][:59], "y"]),
    }


def test_all_pairs_of_one_fingerprint_are_compared(spark, monkeypatch):
    """Not only the first class with each other one: the first is similar to none of them."""
    monkeypatch.setattr(similar_texts, "sketch", lambda grams: (sketch(grams)[0], 7, []))
    docs = spark.createDataFrame(list(_chain().items()), "doc_id bigint, text string")
    assert {row.doc_id for row in drop_similar(docs).collect()} == firsts_of_similar(_chain()) == {1, 2, 4}


def test_all_pairs_of_few_bits_are_compared(spark, monkeypatch):
    """Not only those of a spanning forest: any two fingerprints differ in two bits at most."""
    order = {sketch(shingles(text.encode()))[0]: i for i, text in _chain().items()}
    monkeypatch.setattr(
        similar_texts, "sketch", lambda grams: (key := sketch(grams)[0], 1 << order[key], [])
    )
    docs = spark.createDataFrame(list(_chain().items()), "doc_id bigint, text string")
    assert {row.doc_id for row in drop_similar(docs).collect()} == firsts_of_similar(_chain()) == {1, 2, 4}
