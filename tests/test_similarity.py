"""Similar terms against every pair, with grams that most words hold."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from plumbline.operators import grounding as G
from plumbline.operators import similarity


def plain_grams(term, size=3):
    padded = f" {term} "
    return {padded[i : i + size] for i in range(max(1, len(padded) - size + 1))}


def words(pick, n):
    """Words most of which hold ``ing``, in families one edit apart."""
    out = set()
    while len(out) < n:
        stem = "".join(pick.choice("abcdé日") for _ in range(pick.randint(0, 6))) + (pick.random() < 0.8) * "ing"
        if stem:
            out |= {stem, stem + pick.choice("ab"), stem[1:] or stem}
    return sorted(out)


@pytest.mark.parametrize("threshold", [0.4, 0.6, 0.9, 1.0])
def test_like_every_pair(spark, threshold):
    pick = random.Random(int(threshold * 10))
    asked = [(g, w) for g in (1, 2) for w in words(pick, 60)]
    held = [(g, w) for g in (1, 2, 3) for w in words(pick, 60)]
    got = similarity.similar_terms(
        spark.createDataFrame(asked, "resp_id long, term string"), spark.createDataFrame(held, "resp_id long, term string"), "resp_id", threshold
    )
    want = set()
    for g, a in asked:
        for h, b in held:
            x, y = plain_grams(a), plain_grams(b)
            if g == h and 2 * len(x & y) / (len(x) + len(y)) >= threshold - 1e-12:
                want.add((g, a, b, round(2 * len(x & y) / (len(x) + len(y)), 6)))
    rows = [(r.resp_id, r.term, r.matched_term, r.dice) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want and want


def test_common_grams_come_last(spark):
    """A gram in nearly all words stays out of the prefixes of all words that have others."""
    vocabulary = spark.createDataFrame([(f"{a}{b}{c}ing",) for a in "bcdfg" for b in "aeiou" for c in "klmnp"], "term string")
    found = similarity.prefixes(vocabulary, 0.6)
    assert found.count() == 125
    assert found.filter(F.array_contains("prefix", "ing")).count() == 0
    kept = found.agg(F.sum(F.size("prefix")).alias("p"), F.sum("n_grams").alias("n")).first()
    assert kept.p <= 0.7 * kept.n


def test_fuzzy_step_of_grounding(spark):
    responses = spark.createDataFrame([(1, "Receivings colour xyz colour"), (2, "alone"), (3, None)], "resp_id long, response_text string")
    units = spark.createDataFrame(
        [(1, 0, "s", "color coloured"), (1, 1, "s", "receiving"), (3, 0, "s", "x")], "resp_id long, unit_ix long, source_id string, text string"
    )
    rows = {(r.resp_id, r.ix): (r.g_t, r.matched_term, r.j_star) for r in G.token_grounding_fuzzy(responses, units).collect()}
    assert rows[1, 0][1:] == ("receiving", 1) and 0.6 <= rows[1, 0][0] < 1
    assert rows[1, 1] == rows[1, 3] and rows[1, 1][1:] == ("coloured", 0)
    assert rows[1, 2] == (0.0, None, None) and rows[2, 0] == (0.0, None, None) and len(rows) == 5
    strict = G.token_grounding_fuzzy(responses, units, threshold=0.99)
    assert strict.filter("g_t > 0").count() == 0


def test_grams_stay_with_their_response(spark):
    """Terms are dealt by response only: no vocabulary, gram or pair is shuffled, and texts are cut where they arrive."""
    responses = spark.createDataFrame([(1, "Receivings colour xyz")], "resp_id long, response_text string")
    units = spark.createDataFrame([(1, 0, "s", "color coloured receiving")], "resp_id long, unit_ix long, source_id string, text string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = G.token_grounding_fuzzy(responses, units)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)
    assert dealt and not [e for e in dealt if "gram" in e or "_meet" in e or "matched_term" in e or "resp_id" in e and "," in e]


@pytest.mark.parametrize("block", [1, 7])
def test_packed_terms_in_small_blocks(spark, block):
    """Rows of several terms, repeats across rows, a few pairs at a time: the pairs of single rows."""
    pick = random.Random(5)
    asked, held = ([(g, w) for g in (1, 2) for w in words(pick, 40)] for _ in range(2))
    frame = lambda rows: spark.createDataFrame(rows, "resp_id long, term string")
    packed = lambda rows: frame([(g, "\u0001".join(w for h, w in rows[i::7] if h == g)) for g in (1, 2) for i in (0, 1, 2, 3, 4, 5, 6, 0)] + [(None, "a"), (1, None)])
    want = sorted(map(tuple, similarity.similar_terms(frame(asked), frame(held), "resp_id").collect()))
    got = sorted(map(tuple, similarity.similar_terms(packed(asked), packed(held), "resp_id", packed=True, block=block).collect()))
    assert got == want and want
