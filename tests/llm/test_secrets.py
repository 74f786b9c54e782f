"""Spans against plain regular expressions, and the linking of parts."""

from __future__ import annotations

import re
import time

from oracle_check import differences, open_tables

from casewise.llm.oracle import ORACLE
from casewise.llm.queries import QUERIES
from casewise.llm.secrets import KINDS, find_secrets, redact_secrets

SMALL = "/root/testdata/sf0.001"
BLOB = "aB3" * 15
ACCESS = "AKIA" + "A" * 12


def _base(text):
    found = []
    for listed, (kind, pattern, group, least) in enumerate(
        [
            ("assign", KINDS[0].pattern, 2, 8),
            ("access", r"AKIA[A-Z0-9]+", 0, 16),
            ("hex", r"[0-9a-f]+", 0, 32),
        ]
    ):
        for match in re.finditer(pattern, text or "", re.A):
            if len(match[group]) >= least:
                found.append((match.start(), listed, match.end(), kind))
    return [(kind, start, stop) for start, _, stop, kind in sorted(found)]


def _spans(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {
        row.doc_id: [(s.kind, s.start, s.stop) for s in row.spans] for row in find_secrets(docs).collect()
    }


def test_base_spans(spark):
    texts = [
        'é😀 password = "abcdefgh" token=short secret:longenough1',
        "TOKEN=secret:abcdefghijk api_key='x' apikey=12345678",
        "token=secret=abcdefgh12 " + "ab" * 20 + " " + "AKIA" * 3 + " " + ACCESS + "zz" + ACCESS,
        "passwd:  =  x",
        "f" * 31 + "g" + "0" * 32 + "G" + "e" * 33,
        "token = 12345678" * 50,
        None,
        "",
    ]
    for i, found in _spans(spark, texts).items():
        assert [s for s in found if s[0] in ("assign", "access", "hex")] == _base(texts[i]), texts[i]


def test_weak_parts_need_company(spark):
    url = "postgres://db.example.com/x"
    texts = [
        f"{BLOB}",
        f"{ACCESS} {BLOB}",
        f"{ACCESS} " + "." * 500 + f" {BLOB}",
        f"see {url}",
        f"{ACCESS} {url}",
        f"client_id=bob77 {url} token=12345678",
        "client_id=bob77 and nothing else",
        f"login: joe {BLOB}",
    ]
    kinds = [[kind for kind, *_ in found] for _, found in sorted(_spans(spark, texts).items())]
    assert kinds == [
        [],
        ["access", "blob"],
        ["access"],
        [],
        ["access"],
        ["key_id", "endpoint", "assign"],
        [],
        ["key_id", "blob"],
    ]


def test_reach_is_exact(spark):
    """Parts link up to the reach in either direction, over the border of their stretches."""
    texts = [f"{'.' * lead}{ACCESS}{'.' * gap}{BLOB}" for lead in (0, 390, 399, 401) for gap in (383, 384, 385)]
    for i, found in _spans(spark, texts).items():
        assert len(found) == 1 + (i % 3 < 2), i
    texts = [f"{BLOB}{'.' * gap}{ACCESS}" for gap in (354, 355, 356)]
    assert [len(found) for _, found in sorted(_spans(spark, texts).items())] == [2, 2, 1]


def test_many_parts_in_one_scope(spark):
    """As many rows as parts, not as pairs."""
    text = " ".join([ACCESS, BLOB] * 400)
    assert len(_spans(spark, [text])[0]) == 800


def test_redaction(spark):
    texts = ["keep é", 'a token = "12345678" b', f"{'ab' * 20} {ACCESS}", f"token={'ab' * 20}!", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {row.doc_id: row.text for row in redact_secrets(docs).collect()}
    assert found == {0: "keep é", 1: 'a [assign]" b', 2: "[hex] [access]", 3: "[assign]!", 4: None}


def test_a_very_long_text_full_of_matches(spark):
    """20,000 assignments in characters of one to four bytes: every span, and each of them cut."""
    units = [f"{gap} token=abcdefgh{i:06}" for i, gap in zip(range(20_000), ["é", "-", "𝄞x", "漢字"] * 5_000, strict=True)]
    text = "".join(f"{unit} " for unit in units)
    began = time.monotonic()
    found = _spans(spark, [text])[0]
    expected = [("assign", m.start(), m.end()) for m in re.finditer(r"token=abcdefgh\d{6}", text)]
    assert [tuple(span)[:3] for span in found] == expected
    docs = spark.createDataFrame([(0, text)], "doc_id bigint, text string")
    clean = redact_secrets(docs).first().text
    assert clean == re.sub(r"token=abcdefgh\d{6}", "[assign]", text)
    assert time.monotonic() - began < 120


def test_redaction_of_overlapping_spans_by_plain_loops(spark):
    """Spans that begin inside an earlier one go with it, over the borders of groups too."""
    texts = [
        "é" * n + " ".join([f"secret={BLOB}", ACCESS, f"https://u:{'ab' * 20}@h/x?token={'cd' * 20}"][: 1 + k % 3] * k)
        for n, k in ((0, 1), (3, 2), (5, 63), (1, 64), (2, 65), (0, 200))
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    clean = {row.doc_id: row.text for row in redact_secrets(docs).collect()}
    for i, spans in _spans(spark, texts).items():
        out, at = [], 0
        for kind, start, stop in (tuple(span)[:3] for span in spans):
            if start >= at:
                out.append(texts[i][at:start] + f"[{kind}]")
            at = max(at, stop)
        assert clean[i] == "".join(out) + texts[i][at:]


def test_query(spark):
    name = "op10_secret_scan"
    assert differences(QUERIES[name](spark, SMALL), open_tables(SMALL), ORACLE[name]) == []
