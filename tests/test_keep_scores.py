"""Scores of segments from terms known to every task and rare ones that follow."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plumbline.functions import skew
from plumbline.operators import compress as K


@pytest.mark.parametrize("share", [1, 4, 10_000])
def test_scores_by_definition(spark, monkeypatch, share):
    """Keys null or repeated; all terms rare, some, none."""
    pick = random.Random(7)
    texts = [(pick.choice([None, 1, 1, 2, 3]), " ".join(pick.choice(["a b.", "c 4d.", "e e f.", "a b.", "g."]) for _ in range(pick.randint(0, 6)))) for _ in range(14)]
    monkeypatch.setattr(skew.frequent, "__defaults__", (share,))
    got = sorted((r.doc_id, r.ix, r.text, r.is_repeat, round(r.keep_score, 6)) for r in K.keep_scores(spark.createDataFrame(texts, "doc_id long, text string"), ["doc_id"]).collect())
    cut = [(k, i, s + ".") for k, t in texts for i, s in enumerate(x.strip() for x in t.split(".") if x.strip())]
    df = Counter(w for _, _, s in cut for w in set(s[:-1].split()))
    weight = lambda w: math.log((len(cut) + 1) / (df[w] + 1)) + 1
    want, seen = [], Counter()
    for k, i, s in sorted((c for c in cut if c[0] is not None), key=lambda c: (c[0], c[1])):
        terms = [w for k2, i2, s2 in cut if (k2, i2) == (k, i) for w in set(s2[:-1].split())]
        again = seen[k, s] > 0
        seen[k, s] += 1
        score = 0.0 if again else sum(map(weight, terms)) / len(terms) + ("4" in s)
        want.append((k, i, s, again, round(score, 6)))
    assert got == sorted(want) and len(got) > 20


def test_segments_travel_once(spark):
    """No join by segment: the texts are dealt once, by their key."""
    frame = spark.createDataFrame([(1, "a b. c d. a b.")], "doc_id long, text string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = K.keep_scores(frame, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "hashpartitioning(doc_id" in plan and plan.count("SortMergeJoin") == 1
    assert not [x for x in plan.splitlines() if "Exchange" in x and ", text" in x]


def test_has_preserved(spark):
    texts = ["no", "a1", "٣", "x@y.de", "x@y", "@", "é_7", "", None, "a@b.c d@e.fg"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(K.has_preserved(F.col("t")).alias("got"), F.col("t").rlike(K.PRESERVED).alias("want")).collect()
    assert [r.got for r in rows] == [r.want for r in rows] and {r.got for r in rows} == {True, False, None}
