"""All pairs of similar texts, counted exactly."""

from __future__ import annotations

from itertools import combinations

from casewise.llm.similar_texts import shingles, similarity


def firsts_of_similar(documents, least=0.8):
    """The smallest id of every component of all similar pairs."""
    grams = {i: shingles((text or "").encode()) for i, text in documents.items()}
    root = {i: i for i in documents}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(documents), 2):
        if similarity(grams[a], grams[b]) >= least:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {find(i) for i in documents}
