"""Fill-in-the-middle against string slices, with exact restoration."""

from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import infill

DOCS = "doc_id long, text string"


def plain(doc_id, text):
    """The operator's row by hand."""
    text, digest = text or "", hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:low], text[low:high], text[high:]
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if h[3] % 100 < 20 else "psm", low, high - low, out


def test_cut_like_slices():
    pick = random.Random(1)
    texts = ["".join(pick.choice("ab é日😀\n\x00") for _ in range(pick.randint(0, 30))) for _ in range(500)] + [""]
    low = [pick.randint(0, len(t)) for t in texts]
    high = [pick.randint(a, len(t)) for a, t in zip(low, texts)]
    parts = infill.cut(pa.array(["x", *texts], pa.large_string()).slice(1), pa.array(low, pa.int64()), pa.array(high, pa.int64()))
    want = ([t[:a] for t, a in zip(texts, low)], [t[a:b] for t, a, b in zip(texts, low, high)], [t[b:] for t, b in zip(texts, high)])
    assert [p.to_pylist() for p in parts] == list(want)


def test_long_texts_are_cut_in_pieces(spark):
    texts = ["aé日" * 400_000, "x", "😀" * (infill.SLICE // 4 + 1)]
    rows = [(i, t) for i in range(8) for t in texts]
    got = infill.transform(spark.createDataFrame(rows, DOCS).coalesce(2))
    found = sorted((r.doc_id, tuple(r)[1:]) for r in got.collect())
    assert found == sorted((i, plain(i, t)) for i, t in rows)


@pytest.mark.parametrize("seed", [2, 3])
def test_rows_and_restoration(spark, seed):
    pick = random.Random(seed)
    odd = [None, "", " ", "a", "<P>", "x<S>", "<<M", "<P", "P>", "S>M>", "é日😀\x00\x85", "word " * 9000, "<" * 40, ">" * 40]
    rows = [(pick.choice([None, i, i % 7]), pick.choice(odd)) for i in range(400)]
    frame = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("n", "form", "h1", "output", "prefix_chars")})
    got = infill.transform(frame).select("*", infill.restored().alias("back")).collect()
    key = lambda r: tuple((x is None, x if x is not None else 0) if not isinstance(x, str) else (False, x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(((i, *plain(i, t), t or "") for i, t in rows), key=key)
    assert infill.transform(spark.createDataFrame([], DOCS)).count() == 0
    assert {r.form for r in got} == {"plain", "psm", "spm"}
