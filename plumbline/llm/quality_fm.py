"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

``score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)``. The pairwise sum
is computed in linear time as ``0.5 * sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)``.

Features: hashed words (weight by count, scaled to unit length), one bin per structure
statistic of the text, and one bin of the table's own ``n_chars`` where it is given.
Language, source, id and labels are no inputs. Learning uses a bounded sample of
labelled rows; scoring reads each whole text where it lies, without a shuffle.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import map_rows, per_worker

BUCKETS = 1 << 15
FACTORS = 6
THRESHOLD = 0.3
SAMPLE_DOCS = 3000
CACHE_WORDS = 300_000

SYMBOL = re.compile(r"[#*$%&|<>{}\[\]\\^~_=+@]")
UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
DIGIT = re.compile(r"\d")
STOP = re.compile(r"[.!?](?:\s|$)")
# upper ends of the bins of each statistic
BINS = {
    "words": (0, 5, 10, 20, 50, 100, 200, 500, 1000, 5000),
    "symbols": (0.0, 0.005, 0.02, 0.05, 0.1, 0.2),
    "upper": (0.005, 0.02, 0.05, 0.1, 0.3, 0.6),
    "digits": (0.0, 0.005, 0.02, 0.05, 0.2),
    "bangs": (0.0, 0.01, 0.1, 0.5),
    "pipes": (0.0, 0.01, 0.05, 0.2),
    "distinct": (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),
    "same_next": (0.0, 0.01, 0.05, 0.2, 0.5),
    "length": (2.0, 3.0, 4.0, 5.0, 6.0, 8.0, 12.0),
    "stops": (0.0, 0.01, 0.03, 0.06, 0.1, 0.2),
    "line_words": (1, 3, 6, 12, 25, 50, 100),
    "same_lines": (0.0, 0.05, 0.2, 0.5),
    "top_word": (0.02, 0.04, 0.06, 0.1, 0.2, 0.5),
    "n_chars": (50, 100, 200, 500, 1000, 2000, 5000, 20000),
}
EDGES = [np.array(b, float) for b in BINS.values()]
SIZES = [len(b) + 2 for b in BINS.values()]  # the last bin: not known
STARTS = BUCKETS + np.cumsum([0, *SIZES[:-1]])
WIDTH = BUCKETS + sum(SIZES)


def statistics(text: str, words: list[str], counts: Counter, n_chars: int | None) -> list[float]:
    n, size = max(1, len(words)), max(1, len(text))
    lines = [line for line in text.split("\n") if line.strip()]
    return [
        len(words),
        len(SYMBOL.findall(text)) / size,
        len(UPPER.findall(text)) / size,
        len(DIGIT.findall(text)) / size,
        text.count("!") / n,
        text.count("|") / n,
        len(counts) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        size / n,
        len(STOP.findall(text)) / n,
        n / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        max(counts.values(), default=0) / n,
        np.nan if n_chars is None else n_chars,
    ]


class Buckets(dict):
    """The hash bucket of a word, filled on first use."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        value = self[word] = crc32(word.encode()) % BUCKETS
        return value


def features(text: str | None, n_chars: int | None, buckets: Buckets) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of one text; null is an empty text."""
    text = text or ""
    words = text.split()
    counts = Counter(words)
    at = np.fromiter(map(buckets.__getitem__, counts), np.int64, len(counts))
    value = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    at, place = np.unique(at, return_inverse=True)
    value = np.bincount(place, value, minlength=len(at))
    norm = np.sqrt((value**2).sum())
    stats = statistics(text, words, counts, n_chars)
    bins = [
        start + (len(edges) + 1 if np.isnan(x) else int(np.searchsorted(edges, x)))
        for x, edges, start in zip(stats, EDGES, STARTS.tolist(), strict=True)
    ]
    return np.concatenate([at, bins]), np.concatenate([value / norm if norm else value, np.full(len(bins), 0.5)])


@dataclass
class Model:
    bias: float
    linear: np.ndarray  # (WIDTH,)
    factors: np.ndarray  # (WIDTH, FACTORS)

    def score(self, at: np.ndarray, value: np.ndarray) -> float:
        v = self.factors[at] * value[:, None]
        pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
        z = self.bias + float(self.linear[at] @ value) + pairs
        return float(np.exp(-np.logaddexp(0.0, -z)))


def train(at: np.ndarray, value: np.ndarray, counts: np.ndarray, labels: np.ndarray, rounds: int = 60, rate: float = 0.2, decay: float = 2e-4, seed: int = 7) -> Model:
    """Logistic loss by full-batch Adagrad with L2 decay.

    ``at`` and ``value``: features row after row; ``counts``: features of each row.
    Without both labels the model gives every text the share of good rows (one half
    if there is no row).
    """
    n = len(counts)
    linear, factors = np.zeros(WIDTH), np.random.default_rng(seed).normal(0, 0.05, (WIDTH, FACTORS))
    good = (labels.sum() + 0.5) / (n + 1)
    bias = float(np.log(good / (1 - good)))
    if not n or labels.min() == labels.max():
        return Model(bias, linear.astype(np.float32), np.zeros((WIDTH, FACTORS), np.float32))
    used, at = np.unique(at, return_inverse=True)
    starts = np.cumsum(counts) - counts
    w, v = linear[used], factors[used]
    squares = [np.full(w.shape, 1e-6), np.full(v.shape, 1e-6), 1e-6]
    value2 = value**2
    for _ in range(rounds):
        sums = np.stack([np.add.reduceat(v[at, f] * value, starts) for f in range(FACTORS)], axis=1)
        own = np.add.reduceat(((v**2).sum(axis=1))[at] * value2, starts)
        z = bias + np.add.reduceat(w[at] * value, starts) + 0.5 * ((sums**2).sum(axis=1) - own)
        miss = (1 / (1 + np.exp(-z)) - labels) / n
        each = np.repeat(miss, counts)
        grad_w = np.bincount(at, each * value, minlength=len(w)) + decay * w
        pull = np.bincount(at, each * value2, minlength=len(w))
        grad_v = np.stack(
            [np.bincount(at, each * value * np.repeat(sums[:, f], counts), minlength=len(w)) - pull * v[:, f] for f in range(FACTORS)],
            axis=1,
        ) + decay * v
        squares[0] += grad_w**2
        squares[1] += grad_v**2
        squares[2] += miss.sum() ** 2
        w -= rate * grad_w / np.sqrt(squares[0])
        v -= 0.25 * rate * grad_v / np.sqrt(squares[1])
        bias -= rate * miss.sum() / np.sqrt(squares[2])
    factors = np.zeros((WIDTH, FACTORS), np.float32)
    linear[used], factors[used] = w, v
    return Model(float(bias), linear.astype(np.float32), factors)


def fit(rows: DataFrame, text_col: str = "text", chars_col: str = "n_chars", label_col: str = "quality") -> Model:
    """A model from a bounded sample of labelled rows (:func:`common.labelled_sample`).

    Rows with a null label are left out. Sparse features of the sample reach the driver.
    """
    schema = T.StructType(
        [
            T.StructField("label", T.IntegerType()),
            T.StructField("at", T.ArrayType(T.IntegerType())),
            T.StructField("value", T.ArrayType(T.FloatType())),
        ]
    )

    def step(texts, chars, labels):
        buckets = Buckets()
        found = [features(t, c, buckets) for t, c in zip(texts, chars, strict=True)]
        return [int(x > 0) for x in labels], [f[0].tolist() for f in found], [f[1].tolist() for f in found]

    table = map_rows(rows.filter(F.col(label_col).isNotNull()), [text_col, chars_col, label_col], step, schema).toArrow().combine_chunks()
    at, value = table["at"].combine_chunks(), table["value"].combine_chunks()
    return train(
        at.flatten().to_numpy(), value.flatten().to_numpy().astype(float), at.value_lengths().to_numpy(), table["label"].to_numpy()
    )


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``id_col, score``: the probability that each whole text is good.

    Null and empty texts are scored by their structure bins alone; a null ``n_chars``
    has a bin of its own. Repeated rows are scored one by one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # WIDTH times FACTORS numbers, whatever the input
    key = uuid.uuid4().hex
    schema = T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType())])

    def step(ids, texts, chars):
        buckets = per_worker(key, Buckets)
        return ids, [shared.value.score(*features(t, c, buckets)) for t, c in zip(texts, chars, strict=True)]

    return map_rows(docs, [id_col, text_col, chars_col], step, schema)
