"""Windows against a plain search, in one block and in several."""

from __future__ import annotations

import hashlib
import pickle
import re
import time

from oracle_check import differences, open_tables

from casewise.llm.decontamination import WindowSet, _blocks, contamination, decontaminate
from casewise.llm.oracle import ORACLE
from casewise.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _expected(text, items, width=10):
    words, hit, owners = _words(text), set(), set()
    for item, content in items:
        own = _words(content)
        if item is None or not own:
            continue
        size = min(width, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                owners.add(item)
    return len(words), len(hit), sorted(owners)


def _docs(spark):
    test = " ".join(f"Test{i}," for i in range(14))
    texts = [
        (1, "nothing here"),
        (2, f"before {test} after"),
        (3, " ".join(f"test{i}" for i in range(9))),
        (4, "a short item five WORDS only and short item -- five words; only"),
        (5, " ".join(f"test{i}" for i in range(3, 14)) + " ünd test0"),
        (6, None),
        (7, "short item five words"),
    ]
    return spark.createDataFrame(texts, "doc_id bigint, text string"), dict(texts)


def test_against_plain_search(spark, benchmark_items):
    docs, texts = _docs(spark)
    items = [(row.item_id, row.text) for row in benchmark_items.collect()]
    for block_bytes in (1 << 20, 20):
        found = contamination(docs, benchmark_items, block_bytes=block_bytes).collect()
        for row in found:
            expected = _expected(texts[row.doc_id], items)
            assert (row.n_words, row.n_hit, row["items"]) == expected, row.doc_id
            assert row.contaminated == (expected[1] > 0)


def test_cutting(spark, benchmark_items):
    docs, texts = _docs(spark)
    for block_bytes in (1 << 20, 20):
        kept = {r.doc_id: r.text for r in decontaminate(docs, benchmark_items, 0.9, block_bytes=block_bytes).collect()}
        assert kept[1] == texts[1] and kept[3] == texts[3] and kept[6] is None
        assert kept[2] == "before , after"
        assert kept[5] == " ünd test0"
        assert _words(kept[4]) == ["a", "and"]
    strict = decontaminate(docs, benchmark_items, 0.1)
    assert {row.doc_id for row in strict.collect()} == {1, 3, 6, 7}


def test_cut_joins_no_window(spark, benchmark_items):
    """What a cut brings together is searched again."""
    text = "short item five short item five words only words only end"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert [row.text.split() for row in decontaminate(docs, benchmark_items, 1.0).collect()] == [["end"]]


def _numbered(word, count, start=0):
    return " ".join(f"{word}{i}" for i in range(start, start + count))


def _same_in_blocks(spark, text, items, drop_share):
    docs = spark.createDataFrame([(1, text, 5)], "doc_id bigint, text string, row int")
    table = spark.createDataFrame(items, "item_id string, text string")
    whole, *dealt = (
        [tuple(row) for row in decontaminate(docs, table, drop_share, block_bytes=size).collect()]
        for size in (1 << 20, 60)
    )
    assert all(rows == whole for rows in dealt), (whole, dealt)
    return whole


def test_blocks_judge_and_cut_together(spark):
    """One block or many: the same documents go, and the same words."""
    a, b, own = _numbered("a", 12), _numbered("b", 12), _numbered("own", 16)
    # 30 % of the words from each of two items.
    assert _same_in_blocks(spark, f"{a} {own} {b}", [("a", a), ("b", b)], 0.5) == []
    # Windows of several items that overlap.
    stretch = _numbered("s", 40)
    items = [(str(i), _numbered("s", 16, i)) for i in range(0, 25, 6)]
    left = _same_in_blocks(spark, f"before {stretch} after", items, 1.0)
    assert [row[1].split() for row in left] == [["before", "after"]]
    # A later cut joins a window of another item.
    text = f"{_numbered('a', 6)} {b} {_numbered('a', 6, 6)} end"
    assert [row[1].split() for row in _same_in_blocks(spark, text, [("a", a), ("b", b)], 1.0)] == [["end"]]


def test_one_id_is_dealt_into_blocks(spark):
    """An id with many rows, most of them repeated, does not make one large block."""
    rows = [("a", _numbered(f"t{i % 50}x", 12)) for i in range(400)]
    table = spark.createDataFrame(rows, "item_id string, text string")
    blocks = [items.collect() for items in _blocks(table, table, 600)]
    assert len(blocks) > 4 and sum(map(len, blocks)) == 50
    assert max(sum(len(row.text) for row in block) for block in blocks) < 2400


def test_query(spark):
    name = "op3_decontamination"
    assert differences(QUERIES[name](spark, SMALL), open_tables(SMALL), ORACLE[name]) == []
    empty = hashlib.sha256(b"").hexdigest()
    assert QUERIES[name](spark, SMALL).where(f"items_sha256 = '{empty}' AND contaminated").count() == 0


def test_a_large_block_stays_small(spark):
    """Bytes that are broadcast, against those of the text; and long documents full of windows."""
    words = [f"w{i * 7919 % 100_003}" for i in range(300_000)]
    items = [(str(i), " ".join(words[i : i + 100]).encode()) for i in range(0, 300_000, 100)]
    windows = WindowSet(items, 10)
    size = sum(len(text) for _, text in items)
    assert len(pickle.dumps(windows)) < 6 * size
    began = time.monotonic()
    hit, found = windows.search([word.encode() for word in words])
    assert hit.all() and found == {item for item, _ in items}
    hit, found = windows.search([b"no", b"such", b"words"] * 70_000)
    assert not hit.any() and not found
    hit, found = WindowSet([("a", b"same " * 12), ("b", b"same " * 15)], 10).search([b"same"] * 2_000)
    assert hit.all() and found == {"a", "b"}
    assert time.monotonic() - began < 30
