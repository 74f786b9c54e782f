"""License scans: short notices found with a bounded number of edits.

A notice of which at most k characters may differ is split into k + 1 pieces; whatever the
edits are, one piece survives them. So exact occurrences of the pieces locate all
candidates, and only the stretches around them are searched by the regex library's
bounded-error matching, which verifies the edits and gives the span.

Texts are searched as their words, joined by single spaces, so that punctuation and line
breaks do not count as edits; a match begins and ends at a word. ``BASE`` notices that
stand word for word are base places.

Null and empty texts have no words and no notices. Repeated rows are scanned each, an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from casewise.llm.textops import folded_words, map_texts

# The base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Further notices that the fuzzy search knows.
NOTICES = (
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("bsd license", "bsd"),
    ("isc license", "isc"),
    ("cc by nc", "cc-by-nc"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nd", "cc-by-nd"),
    ("creative commons attribution", "cc-by"),
    ("licensed under the apache license version 2 0", "apache"),
    ("permission is hereby granted free of charge to any person", "mit"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("released into the public domain", "public-domain"),
)
# One edit is allowed for so many characters, and never more than MOST_EDITS.
CHARACTERS_PER_EDIT = 10
MOST_EDITS = 3

SPANS = (
    "array<struct<label:string,first_word:bigint,words:bigint,edits:bigint,text:string,base:boolean>>"
)


@dataclass(frozen=True)
class Notice:
    phrase: str
    label: str
    base: bool

    @property
    def edits(self) -> int:
        return min(MOST_EDITS, len(self.phrase) // CHARACTERS_PER_EDIT)

    @cached_property
    def pieces(self) -> list[tuple[bytes, int]]:
        """The seeds, each with its place in the phrase."""
        count = self.edits + 1
        cuts = [len(self.phrase) * i // count for i in range(count + 1)]
        return [(self.phrase[a:b].encode(), a) for a, b in zip(cuts, cuts[1:], strict=False)]

    @cached_property
    def pattern(self) -> regex.Pattern:
        phrase = regex.escape(self.phrase, literal_spaces=True)
        return regex.compile(f"(?e)(?<= )(?:{phrase}){{e<={self.edits}}}(?= )")

    def stretches(self, text: bytes) -> Iterator[tuple[int, int]]:
        """Around the seeds, joined where they overlap; with a margin for the word's ends."""
        around = []
        for piece, place in self.pieces:
            at = text.find(piece)
            while at >= 0:
                around.append((at - place, at - place + len(self.phrase)))
                at = text.find(piece, at + 1)
        # An edit may be a character of up to four bytes.
        margin = 4 * self.edits + 2
        held: tuple[int, int] | None = None
        for first, last in sorted(around):
            first, last = max(0, first - margin), min(len(text), last + margin)
            if held and first <= held[1]:
                held = held[0], max(held[1], last)
                continue
            if held:
                yield held
            held = first, last
        if held:
            yield held


def catalogue() -> list[Notice]:
    return [Notice(*entry, True) for entry in BASE] + [Notice(*entry, False) for entry in NOTICES]


def _whole_characters(text: bytes, first: int, last: int) -> tuple[int, int]:
    """The stretch without the parts of characters at its ends."""
    while first < last and text[first] & 0xC0 == 0x80:
        first += 1
    while last < len(text) and text[last] & 0xC0 == 0x80:
        last += 1
    return first, last


def _base_places(text: bytes, phrase: str) -> list[int]:
    """Where `` phrase `` stands, overlaps of one space included."""
    mark, places = f" {phrase} ".encode(), []
    at = text.find(mark)
    while at >= 0:
        places.append(at + 1)
        at = text.find(mark, at + len(mark) - 1)
    return places


def scan(words: list[bytes], notices: list[Notice]) -> list[dict]:
    """All spans in a text, by their first word."""
    text = b" " + b" ".join(words) + b" "
    begins = np.cumsum([1, *(len(word) + 1 for word in words)])
    found = []

    def add(notice: Notice, at: int, content: str, edits: int, base: bool) -> None:
        found.append(
            {
                "label": notice.label,
                "first_word": int(np.searchsorted(begins, at, "right")) - 1,
                "words": content.count(" ") + 1,
                "edits": edits,
                "text": content,
                "base": base,
            }
        )

    for notice in notices:
        exact = dict.fromkeys(_base_places(text, notice.phrase) if notice.base else [])
        for at in exact:
            add(notice, at, notice.phrase, 0, True)
        for stretch in notice.stretches(text):
            first, last = _whole_characters(text, *stretch)
            part = text[first:last].decode("utf-8", "replace")
            at, seen = first, 0
            for match in notice.pattern.finditer(part):
                at += len(part[seen : match.start()].encode())
                seen = match.start()
                if at not in exact:
                    add(notice, at, match[0], sum(match.fuzzy_counts), False)
    return sorted(found, key=lambda span: (span["first_word"], span["label"], not span["base"]))


def _likeness(spans: list[dict]) -> float:
    """1 for a verbatim notice, less by the share of characters that differ."""
    return max((max(0.0, 1 - s["edits"] / max(1, len(s["text"]))) for s in spans), default=0.0)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``spans`` and ``score`` (of the closest notice) of every row."""

    def make():
        notices = catalogue()
        kind = pa.list_(
            pa.struct(
                [
                    ("label", pa.string()),
                    ("first_word", pa.int64()),
                    ("words", pa.int64()),
                    ("edits", pa.int64()),
                    ("text", pa.string()),
                    ("base", pa.bool_()),
                ]
            )
        )

        def score(texts: list[bytes]) -> list[pa.Array]:
            words = [folded_words(text) for text in texts]
            spans = [scan(one, notices) for one in words]
            return [
                pa.array([len(one) for one in words], pa.int64()),
                pa.array(spans, kind),
                pa.array([_likeness(one) for one in spans], pa.float64()),
            ]

        return score

    return map_texts(docs, make, f"n_words bigint, spans {SPANS}, score double")
