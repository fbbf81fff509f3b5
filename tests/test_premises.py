"""The best units of items, added up in Arrow batches of whole responses."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.operators import claims as C
from plumbline.operators import grounding as G

WORDS = [f"w{i}" for i in range(12)] + ["é", "ﬁ9"]


def by_definition(items, units, premises):
    """Sums over all pairs; equal keys are one item, equal numbers one unit."""
    df = Counter(t for _, _, text in units for t in set(text.split()))
    weight = lambda t: math.log((len(units) + 1) / (df[t] + 1)) + 1
    mass, overlap = defaultdict(float), defaultdict(lambda: defaultdict(float))
    for resp, ix, text in items:
        for t in set(text.split()):
            mass[resp, ix] += weight(t)
            for other, unit, held in units:
                if resp is not None and other == resp and t in held.split():
                    overlap[resp, ix][unit] += weight(t)
    out = {}
    for key, found in overlap.items():
        best = sorted(found, key=lambda u: (-round(found[u], 6), -math.inf if u is None else u))[:premises]
        out[key] = (round(mass[key], 6), round(found[best[0]], 6), best)
    return out


@pytest.mark.parametrize("block", [1, 1 << 22])
@pytest.mark.parametrize("share", [3, 10_000])
def test_like_all_pairs(spark, monkeypatch, block, share):
    """Ids null or repeated, responses over many batches, terms frequent and rare, blocks of one item."""
    pick = random.Random(5)
    ids = [None, 1, 1, 2, 3, 4, 5]
    text = lambda n: " ".join(pick.choice(WORDS[: pick.choice([3, 14])]) for _ in range(pick.randint(0, n)))
    units = [(pick.choice(ids), pick.choice([None, 0, 1, 2, 5, 9, -3]), text(6)) for _ in range(70)]
    items = [(pick.choice([*ids, 7]), pick.randint(0, 6), text(5) or "w0") for _ in range(40)]
    monkeypatch.setattr(C.skew.frequent, "__defaults__", (share,))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        asked = spark.createDataFrame(items, "resp_id long, claim_ix long, text string").withColumn(G.TERMS, T.distinct_tokens(F.col("text")))
        held = spark.createDataFrame(units, "resp_id long, unit_ix long, text string")
        rows = C.best_premises(asked, held, ["claim_ix"], held, 3, block).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    got = {(r.resp_id, r.claim_ix): (round(r._mass, 6), r._overlap, r._premises) for r in rows}
    assert got == by_definition(items, units, 3) and len(got) == len(rows)
    assert all(r.unit_ix == r._premises[0] for r in rows)


def test_no_pairs_in_the_plan(spark):
    """Items and units are not cut into rows to meet: no row per pair, no window over the terms."""
    responses = spark.createDataFrame([(1, "Rot und blau. Nie grün.")], "resp_id long, response_text string")
    units = spark.createDataFrame([(1, 0, "a", "rot")], "resp_id long, unit_ix long, source_id string, text string")
    plan = C.claim_verification(responses, units)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "collect_list" not in plan


def test_negations_and_offsets(spark):
    text = "No, Nie!  ... \n\n Cannot KEIN noxious 2.5; x"
    row = spark.createDataFrame([(text,)], "t string").select(C._negations(F.col("t")).alias("n")).first()
    assert row.n == 4
    rows = T.piece_rows(spark.createDataFrame([(1, text), (2, None), (3, "")], "k long, t string"), ["k"], "t", T.SEGMENT_END).collect()
    assert [(r.ix, r.text) for r in rows] == [(0, "No, Nie!"), (1, "Cannot KEIN noxious 2.5; x")]
    assert all(text[r.char_start : r.char_end] == r.text for r in rows)
