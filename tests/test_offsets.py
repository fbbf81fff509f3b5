"""Offsets of tokens: sums of lengths by batch against sums inside the row."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from plumbline.functions import text as T


def test_sums_of_lengths(spark):
    pick = random.Random(5)
    rows = [(i, [pick.randint(0, 9) for _ in range(n)]) for i, n in enumerate((0, 1, 2, 700, 0, 33, 5000))]
    rows += [(100, None), (101, [2**31 - 1] * 3)]
    frame = spark.createDataFrame(rows, "id int, a array<int>").coalesce(1).sortWithinPartitions("id")
    out = frame.select("id", "a", T.summed("a").alias("got"), F.when(F.col("a").isNotNull(), T.running_totals(F.col("a"))).alias("want")).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.got == r.want
        assert r.got == (None if r.a is None else [sum(r.a[: i + 1]) for i in range(len(r.a))])


def test_no_fold_over_the_tokens_of_a_text(spark):
    docs = spark.createDataFrame([(1, "Ab, cé  日本! x_y"), (2, None), (3, ""), (4, " .,")], "doc_id int, text string")
    found = T.token_rows(docs, ["doc_id"], "text")
    assert "aggregate(" not in found._jdf.queryExecution().optimizedPlan().toString()
    text = "Ab, cé  日本! x_y"
    got = [tuple(r) for r in found.orderBy("ix").collect()]
    assert [(i, k, t) for i, k, t, *_ in got] == [(1, k, t) for k, t in enumerate(("Ab", "cé", "日本", "x", "y"))]
    assert all(text[a:b] == t for _, _, t, a, b in got)
