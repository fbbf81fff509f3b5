"""Learned heads against numpy and plain counting; sketches against exact values."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import heads, sketches


def newton(x, y, ridge):
    """Logistic regression by plain Newton steps on the whole matrix."""
    x = np.column_stack([np.ones(len(x)), x])
    hold = np.diag([0.0, *[ridge] * (x.shape[1] - 1)])
    beta = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ beta))
        beta += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + hold, x.T @ (y - p) - hold @ beta)
    return beta


def test_head_equals_newton(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3)) * [1.0, 5.0, 0.2]
    y = (rng.random(600) < 1 / (1 + np.exp(-(0.5 + x @ [1.0, -0.3, 4.0])))).astype(int)
    rows = [(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))]
    frame = spark.createDataFrame(rows, "resp_id long, a double, b double, c double, good int")
    head = heads.fit_head(frame, ["a", "b", "c"], "good")
    want = newton(x, y, heads.RIDGE)
    assert np.allclose([head.intercept, *head.weights], want, atol=1e-6)
    scored = {r.resp_id: r for r in heads.apply_head(frame, head).collect()}
    p = 1 / (1 + np.exp(-(want[0] + x @ want[1:])))
    assert all(abs(scored[i].head_score - p[i]) < 2e-6 for i in range(600))
    assert scored[0].head_features_used == ["a", "b", "c"]


def test_head_on_odd_rows(spark):
    schema = "resp_id long, a double, b double, good int"
    # classes that one feature separates, a feature without values, rows without a label
    rows = [(i, float(i), None, int(i >= 10)) for i in range(20)] + [(99, None, None, None)]
    frame = spark.createDataFrame(rows, schema)
    head = heads.fit_head(frame, ["a", "b"], "good")
    scored = {r.resp_id: r for r in heads.apply_head(frame, head).collect()}
    assert scored[0].head_score < 0.1 and scored[19].head_score > 0.9 and scored[99].head_features_used == []
    assert all(map(math.isfinite, [head.intercept, *head.weights])) and head.weights[1] == 0
    empty = heads.fit_head(spark.createDataFrame([], schema), ["a", "b"], "good")
    assert empty == (("a", "b"), 0.0, (0.0, 0.0))
    one_class = heads.fit_head(frame.filter("good = 1"), ["a"], "good")
    assert heads.apply_head(frame.filter("good = 1"), one_class).filter("head_score < 0.9").count() == 0


def words(text):
    return [w.lower() for w in re.findall(r"[^\W_]+", text or "")]


def test_route_by_plain_counting(spark):
    pick = random.Random(2)
    vocabulary = {"en": ["the", "of", "and", "it"], "de": ["der", "und", "it"], "fr": ["le", "et", "un"]}
    docs = [
        (i, lang, " ".join(pick.choice(vocabulary[lang] * 3 + ["common", f"x{pick.randint(0, 9)}"]) for _ in range(pick.randint(1, 12))))
        for i in range(90)
        for lang in [pick.choice(["en", "de", "fr"])]
    ]
    docs += [(100, None, "the und le"), (101, "en", None), (102, "en", "..."), (103, None, "never seen"), (104, None, None)]
    frame = spark.createDataFrame(docs, "doc_id long, lang string, text string")
    learned = [d for d in docs if d[0] % 5 and d[1] and words(d[2])]
    model = heads.fit_route(frame.filter("doc_id % 5 <> 0"), "lang")
    counts = defaultdict(Counter)
    for _, lang, text in learned:
        counts[lang].update(words(text))
    known = set().union(*counts.values())
    sizes = Counter(d[1] for d in learned)
    got = {r.doc_id: r for r in heads.route(frame, "doc_id", model, top=2).collect()}
    assert len(got) == len(docs)
    for doc_id, _, text in docs:
        scores = {}
        for lang in counts:
            mass = sum(counts[lang].values()) + len(known)
            held = [w for w in words(text) if w in known]
            scores[lang] = math.log(sizes[lang] / len(learned)) + sum(math.log((counts[lang][w] + 1) / mass) for w in held)
        top = max(scores.values())
        whole = sum(math.exp(s - top) for s in scores.values())
        order = sorted(scores, key=lambda c: (-scores[c], c))
        row = got[doc_id]
        assert row.class_key == order[0] and row.top_classes == order[:2]
        assert row.probabilities == pytest.approx({c: math.exp(s - top) / whole for c, s in scores.items()}, abs=1e-6)
        assert sum(row.probabilities.values()) == pytest.approx(1, abs=3e-6)


def test_route_without_classes(spark):
    none = spark.createDataFrame([(1, None, "a")], "doc_id long, lang string, text string")
    row = heads.route(none, "doc_id", heads.fit_route(none, "lang")).first()
    assert row.class_key is None and row.probabilities == {} and row.top_classes == []
    many = spark.createDataFrame([(i, f"c{i}", "a") for i in range(9)], "doc_id long, lang string, text string")
    with pytest.raises(ValueError, match="more than 8 classes"):
        heads.fit_route(many, "lang", at_most=8)


def outcomes(spark, n):
    """Most rows in one group and day, some null values and keys."""
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(0).alias("g"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5 * (F.col("id") % 2)).cast("int")).alias("day"),
        F.when(F.col("id") % 11 != 0, F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1_000_000).alias("v"),
        F.when(F.col("id") % 13 != 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n // 4))).alias("k"),
    )
    return rows


def test_sketches_stay_in_their_bounds(spark, tmp_path):
    rows = outcomes(spark, 60_000)
    path = str(tmp_path / "s")
    sketches.save(sketches.daily(rows, ["g"], "day", "v", "k"), path, "day")
    saved = sketches.load(spark, path)
    assert saved.count() == rows.select("g", "day").distinct().count()
    quantiles = sketches.checked_quantiles(rows, saved, "g", "v", (0.01, 0.5, 0.99), 2 * sketches.rank_error())
    assert quantiles.count() == 21 and quantiles.filter("not in_bound").count() == 0
    distinct = sketches.checked_distinct(rows, saved, "g", "k", sketches.distinct_error())
    assert distinct.count() == 8 and distinct.filter("not in_bound").count() == 0
    # a coarse sketch is caught by a bound that is too tight for it
    coarse = sketches.daily(rows, ["g"], "day", "v", "k", k=8, log_k=4)
    assert sketches.checked_quantiles(rows, coarse, "g", "v", (0.25, 0.5, 0.75), 0.0005).filter("not in_bound").count() > 0


def test_days_are_replaced_and_pruned(spark, tmp_path):
    rows, path = outcomes(spark, 4000), str(tmp_path / "s")
    sketches.save(sketches.daily(rows, ["g"], "day", "v", "k"), path, "day")
    before = sketches.merged(sketches.load(spark, path)).first().n
    first = rows.filter("day = DATE'2024-01-01'")
    sketches.save(sketches.daily(first.union(first), ["g"], "day", "v", "k"), path, "day")
    values = first.agg(F.count("v")).first()[0]
    assert sketches.merged(sketches.load(spark, path)).first().n == before + values
    part = sketches.load(spark, path, "2024-01-02", "2024-01-03")
    assert sketches.merged(part).first().n == rows.filter("day between DATE'2024-01-02' and DATE'2024-01-03'").agg(F.count("v")).first()[0]


def test_calibration_from_sketches(spark):
    rows = outcomes(spark, 20_000).withColumn("good", F.col("v") > 0.4).filter("v is not null")
    cuts = sketches.calibration(sketches.daily(rows, ["g", "good"], "day", "v", "k"), "g", "good")
    error = 2 * sketches.rank_error()
    for r in cuts.collect():
        for cut, good, n in ((r.amber_at, "not good", r.n_bad), (r.green_at, "good", r.n_good)):
            own = rows.filter(F.col("g") == r.class_key).filter(good)
            assert own.count() == n
            assert abs(own.filter(F.col("v") <= cut).count() / n - 0.5) <= error + 1 / n
    none = sketches.daily(rows.limit(0), ["g", "good"], "day", "v", "k")
    assert sketches.calibration(none, "g", "good").count() == 0
