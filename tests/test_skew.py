"""The skew-proof forms give what the plain forms give, at any block size."""

import math
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.functions import scan, skew
from plumbline.operators import corpus as Q
from plumbline.operators import postings
from plumbline.operators import sessions as N
from plumbline.session import materialise


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def hot_sessions(spark):
    rng = random.Random(3)
    rows = [(1, t, rng.choice([None, rng.randint(0, 9)])) for t in range(300)]
    rows += [(s, t * 7, rng.randint(0, 9)) for s in range(2, 12) for t in range(rng.randint(1, 9))]
    return spark.createDataFrame(rows, "s int, t int, v int").repartition(5)


def test_prefix_equals_window(spark):
    df = hot_sessions(spark)
    got = scan.prefix(
        df, ["s"], F.col("t"),
        {"n": ("count", F.lit(1)), "sum": ("sum", F.col("v")), "hi": ("max", F.col("v")), "last": ("max", F.struct("t", "v"))},
        block=16,
    )
    w = Window.partitionBy("s").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select(
        "s", "t", "v", F.count(F.lit(1)).over(w), F.coalesce(F.sum("v").over(w), F.lit(0)),
        F.max("v").over(w), F.max(F.struct("t", "v")).over(w),
    )
    assert rows_of(got) == rows_of(want)


def test_trailing_equals_window(spark):
    df = hot_sessions(spark)
    got = scan.trailing(df, ["s"], F.col("t"), 3, {"m": F.col("v")}, block=8).select("s", "t", "m")
    w = Window.partitionBy("s").orderBy("t").rowsBetween(-3, -1)
    assert rows_of(got) == rows_of(df.select("s", "t", F.avg("v").over(w)))


def test_lookup_equals_join(spark):
    rows = spark.createDataFrame([(i, f"k{min(i % 50, 5)}") for i in range(500)] + [(999, "none")], "id int, k string")
    table = rows.filter("k <> 'none'").groupBy("k").agg(F.count("*").alias("f"))
    for hot in (1, 3, 100):
        assert rows_of(skew.lookup(rows, table, "k", "f", ["id"], hot)) == rows_of(
            rows.join(table, "k", "left").select("id", "k", "f")
        )


def test_open_domain_equals_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    docs = [(d, " ".join(rng.choices(words[:8] * 6 + words, k=rng.randint(3, 40)))) for d in range(80)] + [(80, ""), (81, None)]
    asked = [(r, " ".join(rng.choices(words + ["unseen"], k=6))) for r in range(25)] + [(98, "w0 w1"), (99, "unseen")]
    held = {d: set((t or "").split()) for d, t in docs}
    weight = {w: math.log(83 / (1 + sum(w in h for h in held.values()))) + 1 for w in words}
    want = []
    for r, text in asked:
        scores = {d: round(sum(weight[w] for w in h & set(text.split())), 6) for d, h in held.items()}
        best = sorted(((-s, d) for d, s in scores.items() if s > 0))[:3]
        want += [(r, i, d, -s) for i, (s, d) in enumerate(best, 1)]
    corpus = spark.createDataFrame(docs, "doc_id bigint, text string")
    responses = spark.createDataFrame(asked, "resp_id bigint, response_text string")
    for block_docs in (1, 4, 1000):
        got = Q.open_domain_topk(responses, corpus, 3, block_docs)
        assert sorted((r.resp_id, r["rank"], r.doc_id, round(r.score, 6)) for r in got.collect()) == want


def test_common_term_opens_few_blocks(spark):
    """A term in nine of ten documents costs a row per block, and few blocks are opened."""
    docs = [(d, f"rare{d % 400} " + ("common " if d % 10 else "") + f"w{d} v{d % 7}") for d in range(4000)]
    corpus = spark.createDataFrame(docs, "doc_id bigint, text string")
    index = materialise(postings.block_index(corpus, 16), "postings")
    blocks = index.select("block").distinct().count()
    assert 200 <= blocks <= 300 and index.filter("term = 'common'").count() <= blocks
    assert index.filter("term = 'common'").select("part").distinct().count() == postings.PARTS
    asked = spark.createDataFrame([(r, t, w) for r in range(20) for t, w in (("common", 1.1), (f"rare{r}", 6.0))], "resp_id bigint, term string, weight double")
    opened = postings.winning_blocks(asked, index, "resp_id", 3).groupBy("resp_id").count().collect()
    # ten documents hold the rare term, in ten blocks at most
    assert len(opened) == 20 and max(r["count"] for r in opened) <= 10
    assert postings.top_documents(asked, index, "resp_id", 3).filter("score < 6").count() == 0


def test_gap_sessions_equal_plain_sessions(spark):
    rng = random.Random(7)
    rows = [(rng.randint(1, 3), rng.randint(0, 40_000)) for _ in range(400)]
    df = spark.createDataFrame(rows, "u int, s int").selectExpr(
        "u", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) AS ts"
    )
    got = N.gap_sessions(df, "u", "ts", 300).select("u", "start_s", "n_events")
    base = 1_704_067_200
    want, per = [], {}
    for u, s in sorted(rows):
        runs = per.setdefault(u, [])
        if runs and s - runs[-1][2] < 300:
            runs[-1][1] += 1
            runs[-1][2] = s
        else:
            runs.append([s, 1, s])
    want = sorted((u, base + first, n) for u, runs in per.items() for first, n, _ in runs)
    assert rows_of(got) == want


def test_hot_conversation(spark):
    turns = spark.createDataFrame(
        [(1, t, "user" if t % 2 == 0 else "assistant", f"alpha beta w{t} w{t // 3}") for t in range(200)]
        + [(2, 0, "assistant", "alone")],
        "conv_id bigint, turn bigint, role string, text string",
    )
    scores = N.turn_scores(turns)
    bands = {(r["conv_id"], r["turn"]): r["band"] for r in scores.collect()}
    assert bands[2, 0] == "unsupported" and len(bands) == 101
    assert N.band_trail(scores).agg(F.sum("n_turns")).first()[0] == 101
