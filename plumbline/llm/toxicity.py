"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Every sentence has a toxic probability from a
logistic model over hashed words and word beginnings; the document's is their
noisy-or, ``1 - product(1 - p)``. Only document labels are needed: the gradient of the
noisy-or decides which sentences of a toxic document take the blame. After training
the sentence probabilities locate the offending sentences.

Learning uses a bounded, documented sample of labelled rows; scoring reads every text
whole, in the task that reads it, without a shuffle.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import map_rows, per_worker

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]*", re.S)
BUCKETS = 1 << 18
BEGINNINGS = (4, 5, 6)
CACHE_WORDS = 200_000
THRESHOLD = 0.5
SAMPLE_DOCS = 3000


def word_features(word: str) -> tuple[int, ...]:
    """Hash buckets of a lower-cased word and of its beginnings."""
    return (
        crc32(b"w:" + word.encode()) % BUCKETS,
        *(crc32(b"%d:" % k + word[:k].encode()) % BUCKETS for k in BEGINNINGS if len(word) >= k),
    )


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Start and end of each sentence that holds a word: cut after ``.``, ``!``, ``?`` and line ends."""
    if not text:
        return []
    return [m.span() for m in SENTENCE.finditer(text) if WORD.search(m[0])]


@dataclass
class Model:
    weights: np.ndarray  # one per bucket
    bias: float


def _noisy_or(logits: np.ndarray, bags: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sentence probabilities, and per bag the log probability that no sentence is toxic."""
    clean = -np.logaddexp(0.0, logits)  # log(1 - p)
    return -np.expm1(clean), np.bincount(bags, clean, minlength=n)


def train(features: np.ndarray, sizes: np.ndarray, counts: np.ndarray, labels: np.ndarray, rounds: int = 80, rate: float = 2.0, sparse: float = 1e-4, least: int = 5) -> Model:
    """Noisy-or logistic regression by full-batch Adagrad with an L1 penalty.

    ``features``: distinct buckets sentence by sentence; ``sizes``: how many each
    sentence has; ``counts``: how many sentences each document has. Buckets found in
    fewer than ``least`` documents are not learned. The bias starts low, so that
    thousands of harmless sentences together stay harmless. Without both labels the
    model has no weights.
    """
    weights, bias = np.zeros(BUCKETS), -9.0
    n = len(counts)
    if not n or labels.min() == labels.max():
        return Model(weights.astype(np.float32), bias)
    owner = np.repeat(np.arange(n, dtype=np.int32), counts)
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    spread = np.unique(owner[row].astype(np.int64) * BUCKETS + features) % BUCKETS
    used = np.flatnonzero(np.bincount(spread, minlength=BUCKETS) >= least)
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used))
    feature = place[features]
    row, feature = row[feature >= 0], feature[feature >= 0]
    w, square, bias_square = np.zeros(len(used)), np.full(len(used), 1e-8), 1e-8
    balance = np.where(labels == 1, (labels == 0).sum() / (labels == 1).sum(), 1.0) ** 0.5
    for _ in range(rounds):
        logits = np.bincount(row, w[feature], minlength=len(sizes)) + bias
        p, clean = _noisy_or(logits, owner, n)
        toxic = -np.expm1(clean)
        blame = np.where(labels == 1, -np.exp(clean) / np.maximum(toxic, 1e-12), 1.0) * balance
        slope = p * blame[owner] / n
        grad = np.bincount(feature, slope[row], minlength=len(used))
        square += grad**2
        step = rate / np.sqrt(square)
        w -= step * grad
        w = np.sign(w) * np.maximum(np.abs(w) - step * sparse, 0.0)
        g = slope.sum()
        bias_square += g * g
        bias -= 0.3 * g / np.sqrt(bias_square)
    weights[used] = w
    return Model(weights.astype(np.float32), float(bias))


def _features_of(text: str | None) -> tuple[list[int], list[int]]:
    """Feature buckets of all sentences in a row, and how many each sentence has."""
    out: list[int] = []
    sizes: list[int] = []
    text = text or ""
    for a, b in sentences(text):
        found = {f for w in set(WORD.findall(text[a:b].lower())) for f in word_features(w)}
        out += found
        sizes.append(len(found))
    return out, sizes


def fit(rows: DataFrame, text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from a bounded sample of labelled rows (:func:`common.labelled_sample`).

    Rows with a null label are left out, null texts are empty bags. The sample's
    features are computed where the rows are and reach the driver, nothing else.
    """
    rows = rows.filter(F.col(label_col).isNotNull())
    schema = T.StructType(
        [
            T.StructField("label", T.IntegerType()),
            T.StructField("features", T.ArrayType(T.IntegerType())),
            T.StructField("sizes", T.ArrayType(T.IntegerType())),
        ]
    )

    def step(texts, labels):
        both = [_features_of(t) for t in texts]
        return [int(x > 0) for x in labels], [b[0] for b in both], [b[1] for b in both]

    found = map_rows(rows, [text_col, label_col], step, schema).toArrow().combine_chunks()
    features, sizes = found["features"].combine_chunks(), found["sizes"].combine_chunks()
    return train(
        features.flatten().to_numpy(), sizes.flatten().to_numpy(), sizes.value_lengths().to_numpy(), found["label"].to_numpy()
    )


class Scorer:
    """Sentence probabilities with a bounded cache of word weights."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.weight = _Weights(model.weights)

    def logits(self, text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
        spans = sentences(text)
        if len(self.weight) > CACHE_WORDS:
            self.weight.clear()
        lower = text.lower()
        same = len(lower) == len(text)
        parts = [set(WORD.findall(lower[a:b] if same else text[a:b].lower())) for a, b in spans]
        sums = [sum(map(self.weight.__getitem__, words)) for words in parts]
        return spans, np.array(sums, float) + self.model.bias

    def document(self, text: str | None) -> float:
        spans, logits = self.logits(text or "")
        return float(-np.expm1(-np.logaddexp(0.0, logits).sum())) if spans else 0.0


class _Weights(dict):
    """The summed weight of a word's features, filled on first use.

    Features that the training did not see count nothing, so a bucket shared by the
    word and its beginning counts once.
    """

    def __init__(self, weights: np.ndarray) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        value = self[word] = float(sum(self.weights[f] for f in set(word_features(word))))
        return value


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the toxic probability of each whole text in ``out`` (0 for null and wordless texts).

    All other columns are kept; an earlier column of that name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats, whatever the input
    key = uuid.uuid4().hex

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        scorer = per_worker(key, lambda: Scorer(shared.value))
        return pd.Series([scorer.document(t if isinstance(t, str) else None) for t in texts], dtype="float64")

    return docs.withColumn(out, probability(F.col(text_col)))


def offending_sentences(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``id_col, start, end, sentence, probability`` of every sentence at or above ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex
    schema = T.StructType(
        [
            docs.schema[id_col],
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("sentence", T.StringType()),
            T.StructField("probability", T.DoubleType()),
        ]
    )

    def step(ids, texts):
        scorer, rows = per_worker(key, lambda: Scorer(shared.value)), []
        for i, text in zip(ids, texts, strict=True):
            spans, logits = scorer.logits(text or "")
            for (a, b), z in zip(spans, logits, strict=True):
                p = float(np.exp(-np.logaddexp(0.0, -z)))
                if p >= threshold:
                    rows.append((i, a, b, text[a:b], p))
        return tuple(map(list, zip(*rows, strict=True))) if rows else ([], [], [], [], [])

    return map_rows(docs, [id_col, text_col], step, schema)
