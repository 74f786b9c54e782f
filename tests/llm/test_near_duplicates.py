"""Fingerprints, index and components against all pairs."""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from casewise.llm.near_duplicates import GrayTree, components, fingerprint, links, near_duplicates
from casewise.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def _plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(gram.encode(), 42) for gram in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(prints):
    """The smallest member that each value reaches over links of two bits."""
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(prints), 2):
        if (a ^ b).bit_count() <= 2:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbÄ ñ\n\t.", max_size=60))
def test_fingerprint(text):
    assert fingerprint(text.encode()) == _plain_print(text)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 63), max_size=90), st.integers(1, 4), st.integers(0, 3))
def test_tree_finds_every_link(flips, leaves, distance):
    prints = np.unique(
        [(0xF0F0 << (i % 3)) ^ (1 << a) ^ (1 << b) for i, (a, b) in enumerate(zip(flips, flips[1:]))]
        + [0]
    ).astype(np.uint64)
    cuts = sorted({0, *(len(prints) * i // leaves for i in range(leaves))} - {len(prints)})
    leaf = np.searchsorted(cuts, np.arange(len(prints)), "right")
    left, right = GrayTree(prints, np.array(cuts)).links(distance)
    expected = {
        (i, j)
        for i, j in combinations(range(len(prints)), 2)
        if leaf[i] == leaf[j] and int(prints[i] ^ prints[j]).bit_count() <= distance
    }
    assert set(zip(left.tolist(), right.tolist())) == expected
    assert len(left) == len(expected)


def _signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_links_with_small_leaves(spark):
    """A dense group is split over several levels, and no link gets lost."""
    rng = np.random.default_rng(3)
    near = {0x0123456789ABCDEF ^ sum({1 << int(b) for b in rng.integers(0, 64, 3)}) for _ in range(150)}
    far = {int(x) for x in rng.integers(0, 1 << 62, 60)}
    chain = {(1 << n) - 1 for n in range(0, 64, 2)}
    prints = near | far | chain
    rows = [(_signed(p),) for p in prints]
    found = components(links(spark.createDataFrame(rows, "print bigint"), leaf=8)).collect()
    root = {row.member: row.root for row in found}
    classes, expected = {}, {}
    for value, top in _roots(prints).items():
        classes.setdefault(root.get(_signed(value), _signed(value)), set()).add(value)
        expected.setdefault(top, set()).add(value)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, expected.values()))


def test_components_of_stars_and_chains(spark):
    star = [(0, i) for i in range(1, 300)]
    chain = [(1000 + i, 1001 + i) for i in range(40)]
    edges = spark.createDataFrame(star + chain + [(5, 5)], "left bigint, right bigint")
    root = {row.member: row.root for row in components(edges).collect()}
    assert root == {i: 0 for i in range(1, 300)} | {i: 1000 for i in range(1001, 1041)}


def test_query(spark, documents):
    found = QUERIES["op9_simhash_near_dedup"](spark, SMALL).collect()
    prints = {i: _plain_print(text) for i, text in documents.items()}
    roots = _roots(set(prints.values()))
    smallest = {}
    for i, value in prints.items():
        smallest[roots[value]] = min(i, smallest.get(roots[value], i))
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {
        (i, f"{value:016x}", smallest[roots[value]]) for i, value in prints.items()
    }


def test_documents_without_ids(spark):
    docs = spark.createDataFrame(
        [(None, "a b c d"), (7, "a b c d"), (None, "other words stand here")], "doc_id bigint, text string"
    )
    assert sorted(
        (row.doc_id is None, row.component_id or 0) for row in near_duplicates(docs).collect()
    ) == [(False, 7), (True, 0), (True, 7)]
