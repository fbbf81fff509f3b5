"""Names in texts against a scan from left to right."""

from __future__ import annotations

import random
import re

import pytest

from plumbline.operators import names

WORD = re.compile(r"[^\W_]+")


def scan(text, phrases):
    """Longest phrase first, left to right: ``(ix, n, label, start, end)``."""
    tokens = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text or "")]
    out, i = [], 0
    while i < len(tokens):
        for n in range(min(6, len(tokens) - i), 0, -1):
            label = phrases.get(tuple(t[0] for t in tokens[i : i + n]))
            if label is not None:
                out.append((i, n, label, tokens[i][1], tokens[i + n - 1][2]))
                i += n
                break
        else:
            i += 1
    return out


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_like_a_scan(spark, broadcast_rows):
    pick = random.Random(1)
    words = ["the", "the", "the", "ann", "lee", "de", "Étoile", "日本", "x1", "b"]
    known = {(" ".join(pick.choice(words) for _ in range(pick.randint(1, 4))), pick.choice("pq")) for _ in range(25)}
    known |= {("the the", "t"), ("the the lee", "u"), ("Lee", "v"), ("ANN-Lee", "w"), ("...", "none"), (None, "none")}
    phrases = {}
    for name, label in sorted(known, key=lambda k: k[1], reverse=True):
        tokens = tuple(w.lower() for w in WORD.findall(name or ""))
        if tokens:
            phrases[tokens] = label
    joints = [" ", ", ", "-", "\n", " .. "]
    docs = [(i, "".join(pick.choice(words) + pick.choice(joints) for _ in range(pick.randint(0, 60)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "THE the THE the lee"), (103, "the " * 3000)]
    got = names.detect_names(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(known), "name string, label string"), "doc_id", "text",
        broadcast_rows=broadcast_rows,
    )
    want = sorted((d, *span) for d, text in docs for span in scan(text, phrases))
    assert sorted(tuple(r) for r in got.collect()) == want


def test_no_names_or_texts(spark):
    docs = spark.createDataFrame([(1, "the ann")], "doc_id long, text string")
    empty = spark.createDataFrame([], "name string, label string")
    assert names.detect_names(docs, empty, "doc_id", "text").count() == 0
    some = spark.createDataFrame([("ann", "p")], "name string, label string")
    assert names.detect_names(docs.limit(0), some, "doc_id", "text").count() == 0
