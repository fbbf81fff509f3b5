"""Rows of one group meet on their terms, with one shuffle by group."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.functions.meet import meet
from plumbline.operators import claims as C
from plumbline.operators import grounding as G
from plumbline.operators import similarity


def exchanges(df):
    """Columns that the plan deals rows by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)


@pytest.fixture
def plain(spark):
    """Joins of any size as on large tables: none is broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_like_a_join(spark):
    pick = random.Random(3)
    group = lambda: pick.choice([None, 1, 1, 2, 3])
    asked = [(group(), pick.choice("abcdé"), i) for i in range(60)] * 2
    held = [(group(), pick.sample("abcdé", pick.randint(0, 3)), pick.choice([None, j])) for j in range(40)]
    left = spark.createDataFrame(asked, "g long, k string, a long")
    right = spark.createDataFrame(held, "g long, k array<string>, h long").withColumn("k", T.packed(F.col("k")))
    got = [tuple(r) for r in meet(left, right, "g", "k", "key").select("g", "key", "a", "h").collect()]
    want = [(g, k, a, h) for (g, k, a), (x, ks, h) in itertools.product(asked, held) if g is not None and g == x and k in ks]
    assert sorted(got, key=repr) == sorted(want, key=repr) and want


def requests(spark):
    responses = [(1, "Rot und blau. Nie grün, 4 mal."), (1, "Rot noch einmal."), (None, "Rot."), (2, None), (3, "?!")]
    units = [(1, 0, "a", "rot rot BLAU"), (1, 1, "a", ""), (1, 1, "b", "grün 4"), (None, 0, "a", "rot"), (2, 0, "a", "x"), (4, 0, "a", None)]
    return (
        spark.createDataFrame(responses, "resp_id long, response_text string"),
        spark.createDataFrame(units, "resp_id long, unit_ix long, source_id string, text string"),
    )


@pytest.mark.parametrize("saved", [False, True])
def test_null_and_repeated_ids(spark, saved):
    """A null id meets no unit, texts of one id are one response, where it counts terms."""
    responses, units = G.tokenised(*requests(spark)) if saved else requests(spark)
    terms = {(r.resp_id, r.term): (r.n, r.g) for r in G.grounded_terms(responses, units).collect()}
    assert terms[1, "rot"] == (2, 1) and terms[1, "und"] == (1, 0) and terms[None, "rot"] == (1, 0)
    assert {k[0] for k in terms} == {1, None}
    tokens = sorted((r.resp_id or 0, r.ix, r.token, r.char_start, r.char_end, r.g_t) for r in G.grounded_positions(responses, units).collect())
    assert tokens[:3] == [(0, 0, "Rot", 0, 3, 0.0), (1, 0, "Rot", 0, 3, 1.0), (1, 0, "Rot", 0, 3, 1.0)]
    assert (1, 4, "grün", 18, 22, 1.0) in tokens and len(tokens) == 11
    novel = {tuple(r) for r in G.novel_tokens(responses, units).collect()}
    assert novel == {(1, w) for w in ("und", "nie", "mal", "noch", "einmal")}


def test_terms_travel_once(plain):
    """After rows are dealt by response, neither pairs nor tokens are dealt again."""
    responses, units = G.tokenised(*requests(plain))
    assert all("term" not in e for e in exchanges(G.reverse_context(responses, units)))
    assert all("term" not in e for e in exchanges(G.unsupported_spans(responses, units)))
    claims = C.claim_verification(responses, units)
    assert not [e for e in exchanges(claims) if "unit_ix" in e and "term" in e]
    assert not [e for e in exchanges(G.matched(G.response_terms(responses), units).groupBy("resp_id", "unit_ix").count()) if "unit_ix" in e]


def test_similar_pairs_stay(plain):
    """Pairs that share a gram are counted where they met, not dealt by pair."""
    rows = plain.createDataFrame([(1, "singing"), (1, "sing"), (2, "singen")], "resp_id long, term string")
    found = similarity.similar_terms(rows, rows, "resp_id")
    assert not [e for e in exchanges(found) if "gram" in e or "matched_term" in e and "resp_id" in e]


def test_one_exchange_for_all_results(plain):
    """Weights are looked up without a shuffle by term of what is said; several results deal the same rows once."""
    responses, units = G.tokenised(*requests(plain))
    for result in (G.owners, G.unit_coverage, G.grounded_weights):
        assert not [e for e in exchanges(result(responses, units)) if "_meet" in e or "unit_ix" in e or "resp_id" in e and "term" in e]
    both = G.owners(responses, units).groupBy("resp_id").count().unionByName(G.unit_coverage(responses, units).groupBy("resp_id").count())
    both = both.unionByName(G.reverse_context(responses, units).select("resp_id", F.lit(0).alias("count")))
    both = both.unionByName(G.unsupported_spans(responses, units).select("resp_id", F.lit(0).alias("count")))
    both.collect()
    plan = both._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]
    made = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line and "ReusedExchange" not in line]
    assert len(made) == 2


def test_owners_by_definition(spark):
    """Ids and numbers null or repeated, texts of one id one response, terms frequent and rare."""
    pick, ids, words = random.Random(7), [None, 1, 1, 2, 3, 4], [f"w{i}" for i in range(12)]
    text = lambda n: " ".join(pick.choice(words[: pick.choice([3, 12])]) for _ in range(pick.randint(0, n)))
    said = [(pick.choice([*ids, 9]), text(9)) for _ in range(12)]
    held = [(pick.choice(ids), pick.choice([None, 0, 1, 2, -5]), "s", text(6)) for _ in range(60)]
    df = Counter(t for _, _, _, u in held for t in set(u.split()))
    terms, weight = defaultdict(Counter), lambda t: math.log((len(held) + 1) / (df[t] + 1)) + 1
    for resp, t in said:
        terms[resp].update(t.split())
    overlap = defaultdict(float)
    for resp, ix, _, u in held:
        overlap[resp, ix] += sum(weight(t) for t in set(u.split()) if resp is not None and t in terms[resp])
    responses = spark.createDataFrame(said, "resp_id long, response_text string")
    units = spark.createDataFrame(held, "resp_id long, unit_ix long, source_id string, text string")
    for r, u in ((responses, units), G.tokenised(responses, units)):
        got = {(x.resp_id, x.term): x.j_star for x in G.owners(r, u).collect()}
        want = {}
        for resp in terms:
            for t in terms[resp]:
                by = [ix for other, ix, _, unit in held if resp is not None and other == resp and t in unit.split()]
                if by:
                    want[resp, t] = min(by, key=lambda ix: (-round(overlap[resp, ix], 6), -math.inf if ix is None else ix))
        assert got == want and want
        rows = Counter((x.resp_id, x.unit_ix, round(x.coverage, 5)) for x in G.unit_coverage(r, u).collect())
        mass = {resp: sum(weight(t) for t in terms[resp]) for resp in terms}
        shares = Counter((resp, ix, round(overlap[resp, ix] / mass[resp], 5) if ix is not None and mass.get(resp) else 0.0) for resp, ix, _, _ in held)
        assert rows == shares
        n = {(x.resp_id, x.term): (x.n, x.g, round(x.weight, 9)) for x in G.grounded_weights(r, u).collect()}
        assert n == {(resp, t): (c, int((resp, t) in want), round(weight(t), 9)) for resp in terms if resp is not None for t, c in terms[resp].items()}


def test_saved_frames_without_rows(spark):
    """Either table may be empty; both are read back with their columns."""
    responses, units = requests(spark)
    for r, u in ((responses.limit(0), units), (responses, units.limit(0)), (responses.limit(0), units.limit(0))):
        saved, held = G.tokenised(r, u)
        assert (saved.count(), held.count()) == (r.count(), u.count())
        assert saved.columns == [*r.columns, G.TOKENS] and held.columns == [*u.columns, G.TERMS]
        assert G.unit_coverage(saved, held).count() == u.count() and G.owners(saved, held).count() == 0
