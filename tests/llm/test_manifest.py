"""The manifest against trees made of plain lists, and what its proofs show."""

from __future__ import annotations

import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casewise.llm import queries
from casewise.llm.manifest import dataset_manifest, descend, digest, fold, grow
from casewise.llm.textops import read_table

SMALL = "/root/testdata/sf0.001"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def rows_of(texts):
    """Rows of the awkward table's columns."""
    return [(i, text, "en", "src0", len(text), 7, "r", "h", 8, "p", "f", 9) for i, text in texts]


def _h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    texts = (None if row[name] is None else str(row[name]) for name in FIELDS)
    return _h(*("-" if text is None else f"{len(text.encode())}:{text}" for text in texts))


def _proofs(leaves):
    """The root of a list of leaves, and each one's siblings with their sides."""
    paths, nodes = [[] for _ in leaves], [(leaf, [i]) for i, leaf in enumerate(leaves)]
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), 2):
            pair = nodes[at : at + 2]
            for side, (_, below) in enumerate(pair):
                for i in below:
                    paths[i].append((side, pair[1 - side][0] if len(pair) == 2 else ""))
            above.append((_h(*(node for node, _ in pair)), [i for _, below in pair for i in below]))
        nodes = above
    return nodes[0][0], paths


def _expected(rows):
    langs = defaultdict(list)
    for row in rows:
        langs[row["lang"]].append(row)
    names = sorted(langs, key=lambda lang: (lang is not None, (lang or "").encode()))
    for name in names:
        langs[name].sort(key=lambda row: (row["doc_id"] is not None, row["doc_id"] or 0, _leaf(row)))
    trees = {name: _proofs([_leaf(row) for row in langs[name]]) for name in names}
    if not names:
        return []
    root, tops = _proofs([trees[name][0] for name in names])
    found = []
    for name, top in zip(names, tops, strict=True):
        for row, path in zip(langs[name], trees[name][1], strict=True):
            touched = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            claim = dict(row)
            if touched and row["n_chars"] is not None:
                claim["n_chars"] += 1
            node = _leaf(claim)
            for side, sibling in path + top:
                node = _h(sibling, node) if side else _h(node, sibling)
            proof = _h(*(sibling for _, sibling in path + top))
            found.append((row["doc_id"], _leaf(row), trees[name][0], root, proof, node, node == root))
    return sorted(found, key=repr)


def _found(docs, span):
    fields = {name: F.col(name) for name in FIELDS}
    touched = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    longer = digest(*(fields | {"n_chars": F.col("n_chars") + 1}).values())
    leaf = digest(*fields.values())
    found = dataset_manifest(docs, leaf, F.when(touched, longer).otherwise(leaf), F.col("lang"), F.col("doc_id"), span)
    rows = found.select("key", "leaf", "subroot", "root", "proof", "folded", F.expr("folded = root")).collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("span", [1, 3, 10])
def test_given_table(spark, span):
    docs = read_table(spark, SMALL, "documents")
    rows = [row.asDict() for row in docs.collect()]
    assert _found(docs, span) == _expected(rows)


def test_query_finds_the_tampered_rows(spark):
    docs = read_table(spark, SMALL, "documents")
    result = queries.op12_merkle_manifest(spark, SMALL)
    found = sorted([tuple(row) for row in result.collect()], key=repr)
    assert found == _expected([row.asDict() for row in docs.collect()])
    assert {row[6] for row in found} == {True, False}


def test_awkward_rows(spark, awkward):
    assert _found(awkward, 2) == _expected([row.asDict() for row in awkward.collect()])


def test_ties_and_many_names(spark, awkward):
    """One row a hundred times, and a tree for each of many names, null and empty ones included."""
    rows = rows_of([(7, "the same")] * 100) + rows_of([(i, f"text {i}") for i in range(40)])
    rows = [(*row[:2], lang, *row[3:]) for row, lang in zip(rows, ["en"] * 100 + [None, "", "é", "z", *map(str, range(36))], strict=True)]
    docs = spark.createDataFrame(rows, awkward.schema)
    assert _found(docs, 2) == _expected([row.asDict() for row in docs.collect()])


def test_one_row_and_none(spark, awkward, nothing):
    one = spark.createDataFrame(rows_of([(7, "alone")]), awkward.schema)
    found = _found(one, 10)
    assert found == _expected([one.first().asDict()])
    assert found[0][1] == found[0][2] == found[0][3] and found[0][4] == _h()
    assert _found(nothing, 10) == []


@given(st.integers(1, 70), st.integers(0, 3))
def test_descent_leads_back_to_the_root(size, more):
    leaves = [_h(str(i)) for i in range(size)]
    levels = grow(leaves, (size - 1).bit_length() + more)
    assert len(levels[-1]) == 1
    for leaf, way in zip(leaves, descend(levels), strict=True):
        assert fold(leaf, way[::-1]) == levels[-1][0]
        assert fold(_h("other"), way[::-1]) != levels[-1][0]
