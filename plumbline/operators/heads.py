"""Learned heads: a logistic score over lane features and a Bayes route over terms.

Both fits are sums over the rows, made where the rows are: a step of the logistic fit
brings one small matrix to the driver, the route is a table of term counts per class.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import skew
from plumbline.functions import text as T
from plumbline.functions.text import r6
from plumbline.session import materialise

STEPS = 25
RIDGE = 1e-3
TOLERANCE = 1e-9


class Head(NamedTuple):
    """Weights of the intercept and of each feature."""

    features: tuple[str, ...]
    intercept: float
    weights: tuple[float, ...]


def _logit(intercept: float, weights: Sequence[float], features: Sequence[str]) -> Column:
    total = F.lit(float(intercept))
    for w, name in zip(weights, features, strict=True):
        total = total + F.lit(float(w)) * F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    return total


def fit_head(rows: DataFrame, features: Sequence[str], label: str, ridge: float = RIDGE, steps: int = STEPS) -> Head:
    """Logistic regression of ``label`` (0 or 1) by reweighted least squares.

    A missing feature counts as 0; rows without a label are left out. Each step is one
    aggregate of ``(d + 1) (d + 2) / 2 + d + 1`` sums for ``d`` features, so what reaches the
    driver does not grow with the rows. ``ridge`` holds the weights, not the intercept,
    near 0, which keeps separable classes finite. Without rows all weights are 0.
    """
    names = list(features)
    kept = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in names]
    data = materialise(rows.filter(F.col(label).isNotNull()).select(*kept, F.col(label).cast("double").alias("_y")), "head")
    x = [F.lit(1.0), *(F.col(f) for f in names)]
    size = len(x)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    hold = np.diag([0.0, *[ridge] * len(names)])
    beta = np.zeros(size)
    for _ in range(steps):
        odds = data.withColumn("_p", 1 / (1 + F.exp(-_logit(beta[0], beta[1:], names))))
        spread = F.col("_p") * (1 - F.col("_p"))
        sums = odds.agg(
            *(F.sum(spread * x[i] * x[j]).alias(f"g{i}_{j}") for i, j in pairs),
            *(F.sum((F.col("_y") - F.col("_p")) * x[i]).alias(f"r{i}") for i in range(size)),
        ).first()
        if sums["r0"] is None:
            break
        gram = np.zeros((size, size))
        for i, j in pairs:
            gram[i, j] = gram[j, i] = sums[f"g{i}_{j}"]
        rest = np.array([sums[f"r{i}"] for i in range(size)]) - hold @ beta
        move = np.linalg.lstsq(gram + hold, rest, rcond=None)[0]
        # a step across a flat region is shortened, so that it cannot overshoot
        move *= min(1.0, 5.0 / max(float(np.abs(move).max()), 1e-300))
        beta = beta + move
        if np.abs(move).max() < TOLERANCE:
            break
    return Head(tuple(names), float(beta[0]), tuple(map(float, beta[1:])))


def head_score(head: Head) -> Column:
    """The probability that a head gives a row."""
    return r6(1 / (1 + F.exp(-_logit(head.intercept, head.weights, head.features))))


def apply_head(rows: DataFrame, head: Head) -> DataFrame:
    """``rows`` with ``head_score`` and ``head_features_used``, the features that a row has."""
    used = F.array_compact(F.array(*(F.when(F.col(f).isNotNull(), F.lit(f)) for f in head.features)))
    return rows.withColumns({"head_score": head_score(head), "head_features_used": used})


def term_counts(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, term, n``."""
    return T.exploded(docs, [key], T.tokens(F.col(text)), "term").groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))


def fit_route(docs: DataFrame, label: str, text: str = "text", at_most: int = 100) -> tuple[DataFrame, DataFrame]:
    """Multinomial naive Bayes from ``docs``: ``(terms, classes)``.

    ``terms`` has ``term, df`` and an array ``counts`` of the term's uses in each class;
    ``classes`` has ``class_key, place, prior, mass`` with the log of the share of documents and
    the log of the smoothed number of tokens. Documents without a label or a token teach
    nothing. More than ``at_most`` classes is an error: every row of ``terms`` holds one
    number for each.
    """
    known = docs.filter(F.col(label).isNotNull() & T.has_token(F.col(text))).select(F.col(label).alias("_class"), F.col(text).alias("_text"))
    sizes = known.groupBy("_class").agg(F.count(F.lit(1)).alias("n_docs"))
    found = [r["_class"] for r in sizes.orderBy("_class").limit(at_most + 1).collect()]
    if len(found) > at_most:
        raise ValueError(f"more than {at_most} classes in {label}")
    uses = T.exploded(known, ["_class"], T.tokens(F.col("_text")), "term").groupBy("term", "_class").agg(F.count(F.lit(1)).alias("n"))
    counts = [F.coalesce(F.sum(F.when(F.col("_class") == c, F.col("n"))), F.lit(0)) for c in found]
    terms = materialise(uses.groupBy("term").agg(F.sum("n").alias("df"), F.array(*counts).alias("counts")), "route-terms")
    vocabulary = terms.count()
    total = known.count()
    masses = terms.select(F.posexplode("counts").alias("place", "c")).groupBy("place").agg(F.log(F.sum("c") + vocabulary).alias("mass"))
    places = F.array_position(F.array(*map(F.lit, found)), F.col("_class")) - 1 if found else F.lit(0)
    classes = sizes.withColumn("place", places.cast("int")).join(masses, "place").select(
        F.col("_class").alias("class_key"), "place", F.log(F.col("n_docs") / total).alias("prior"), "mass"
    )
    return terms, materialise(classes, "route-classes")


def route(docs: DataFrame, key: str, model: tuple[DataFrame, DataFrame], text: str = "text", top: int = 3) -> DataFrame:
    """``key, class_key, confidence, probabilities, top_classes`` of every document.

    ``probabilities`` maps each class to its posterior; ``top_classes`` names the ``top`` likeliest,
    ties in the order of the names. Terms never learned count for nothing, and a
    document without a known term has the shares of the classes. Common terms are looked up
    on the map side.
    """
    terms, classes = model
    # one row per class
    known = classes.orderBy("place").collect()
    asked = term_counts(docs, key, text)
    met = skew.lookup(asked, terms, "term", "df", [key, "term"]).filter("counts is not null")
    sums = met.groupBy(key).agg(
        F.sum("n").alias("_n"),
        *(F.sum(F.col("n") * F.log(F.col("counts")[c["place"]] + 1)).alias(f"_s{c['place']}") for c in known),
    )
    zero = F.lit(0.0)
    scores = [
        F.struct(
            (F.lit(c["prior"]) + F.coalesce(f"_s{c['place']}", zero) - F.coalesce("_n", F.lit(0)) * F.lit(c["mass"])).alias("score"),
            F.lit(c["class_key"]).alias("name"),
        )
        for c in known
    ]
    if not known:
        none = F.lit(None).cast("string")
        return docs.select(key, none.alias("class_key"), F.lit(None).cast("double").alias("confidence"), F.create_map().cast("map<string,double>").alias("probabilities"), F.array().cast("array<string>").alias("top_classes"))
    ranked = F.array_sort(F.transform(F.array(*scores), lambda s: F.struct((-s["score"]).alias("minus"), s["name"].alias("name"))))
    placed = docs.select(key).join(sums, key, "left").withColumn("_ranked", ranked)
    best = F.col("_ranked")[0]["minus"]
    weights = F.transform("_ranked", lambda s: F.struct(s["name"].alias("name"), F.exp(best - s["minus"]).alias("w")))
    whole = F.aggregate("_weights", zero, lambda a, s: a + s["w"])
    shares = F.transform("_weights", lambda s: F.struct(s["name"].alias("key"), r6(s["w"] / F.col("_whole")).alias("value")))
    return placed.withColumn("_weights", weights).withColumn("_whole", whole).select(
        key,
        F.col("_weights")[0]["name"].alias("class_key"),
        r6(F.col("_weights")[0]["w"] / F.col("_whole")).alias("confidence"),
        F.map_from_entries(F.array_sort(shares)).alias("probabilities"),
        F.transform(F.slice("_weights", 1, top), lambda s: s["name"]).alias("top_classes"),
    )
