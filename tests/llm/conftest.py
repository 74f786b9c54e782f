"""Small tables: the given ones, awkward ones and empty ones."""

from __future__ import annotations

import pytest

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

# Columns whose names the operators use inside.
CLASHING = "score int, row string, hits string, key bigint, print string, found string, size int"
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}"
EXTRA = (7, "r", "h", 8, "p", "f", 9)


def rows_of(texts):
    return [(i, text, "en", "src0", None if text is None else len(text), *EXTRA) for i, text in texts]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, repeated rows, shared ids, clashing names."""
    long_text = " ".join(f"wörd{i % 977} the, and" + ("." if i % 9 == 0 else "") for i in range(60_000))
    rows = rows_of(
        [
            (None, None),
            (None, "without an id. It says something, and more."),
            (1, ""),
            (2, None),
            (3, long_text),
            (4, "the same row twice"),
            (4, "the same row twice"),
            (5, "one id, two texts: first"),
            (5, "one id, two texts: second"),
            (6, "x" * 200_000),
            (7, " \n\t  \r\n "),
            (8, "12 34 !? 56"),
        ]
    )
    rows.append((9, "null columns", None, None, None, *[None] * len(EXTRA)))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def benchmark_items(spark):
    rows = [
        ("a", " ".join(f"test{i}" for i in range(14))),
        ("b", "Short item, five words only"),
        ("b", "Short item, five words only"),
        ("c", None),
        (None, "an item without an id is none"),
        ("d", "!!!"),
    ]
    return spark.createDataFrame(rows, "item_id string, text string")


@pytest.fixture(scope="session")
def documents(spark):
    """Texts of the given table: doc_id to text."""
    found = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return {row.doc_id: row.text for row in found}
