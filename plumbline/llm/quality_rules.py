"""Quality rules: base counts, and a linear-chain conditional random field over lines.

Each line with a word gets features; the Viterbi path through the field marks lines as
content or boilerplate, and the share of words in content lines decides whether a
document stays. The field is learned from document labels: in a bounded sample, the
lines of good documents count as content, and those of bad documents as boilerplate.

Counting and labelling happen in one pass where the text is read; nothing is shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import map_rows

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEATED = 20, 30
CONTENT_SHARE = 0.5
SAMPLE_DOCS = 2000

BOILERPLATE, CONTENT = 0, 1
# upper ends of the bins that a line's measures fall into
BINS = {
    "words": (1, 3, 6, 12, 40),
    "symbols": (0.0, 0.02, 0.05, 0.1, 0.2),
    "marks": (0.0, 0.1, 0.3, 0.6),
    "upper": (0.02, 0.1, 0.3, 0.6),
    "distinct": (0.1, 0.3, 0.5, 0.7, 0.85),
    "same_next": (0.0, 0.1, 0.3),
    "digits": (0.0, 0.05, 0.2),
    "length": (2.5, 4.0, 6.0, 9.0),
    "repeats": (0.0, 0.2, 0.5),
    "ends": (0.5,),
    "seen": (0.5,),
}
SIZES = [len(b) + 1 for b in BINS.values()]
STARTS = np.cumsum([0, *SIZES[:-1]])
WIDTH = sum(SIZES)
EDGES = [np.array(b) for b in BINS.values()]
SYMBOL = re.compile(f"[{re.escape(SYMBOLS)}]")
UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
DIGIT = re.compile(r"\d")
MARK = re.compile(r"[!?;:_=+~^]")


@dataclass
class Base:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    repeated: np.ndarray  # per word: inside a window found twice or more

    @property
    def failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEATED * self.n_words


def repeated_words(words: list[bytes], window: int = WINDOW) -> np.ndarray:
    """Per word whether it lies in a window of ``window`` words (a power of two) found twice or more.

    Windows are numbered exactly, not hashed: equal words get equal numbers, then
    neighbouring numbers are paired and numbered again until a pair spans the window.
    """
    hit = np.zeros(len(words), bool)
    if len(words) <= window:
        return hit
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return hit
    span = 1
    while span < window:
        codes = np.unique(codes[:-span] * (codes.max() + 1) + codes[span:], return_inverse=True)[1]
        span *= 2
    often = np.bincount(codes)[codes] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(often), 1)
    np.add.at(cover, np.flatnonzero(often) + window, -1)
    return np.cumsum(cover)[:-1] > 0


def measure(text: str | None) -> tuple[Base, list[tuple[str, list[bytes]]]]:
    """Base counts of a text, and its lines that hold a word with their words."""
    lines, words, seen, dups = [], [], set(), 0
    for line in (text or "").split("\n"):
        own = line.encode().split()
        if own:
            dups += line in seen
            seen.add(line)
            lines.append((line, own))
            words += own
    n_bytes = sum(map(len, words))
    # code points: bytes that do not continue a character
    more = sum(len(line) for line, _ in lines) - sum(len(line.encode()) for line, _ in lines)
    repeated = repeated_words(words)
    symbols = sum((text or "").count(c) for c in SYMBOLS)
    return Base(len(words), n_bytes + more, symbols, dups, int(repeated.sum()), repeated), lines


def line_features(lines: list[tuple[str, list[bytes]]], repeated: np.ndarray) -> np.ndarray:
    """The bin of each measure of each line, as columns of a one-hot row of ``WIDTH``."""
    rows, seen, at = [], set(), 0
    for line, words in lines:
        n, size = len(words), max(1, len(line))
        rows.append(
            (
                n,
                len(SYMBOL.findall(line)) / size,
                len(MARK.findall(line)) / n,
                len(UPPER.findall(line)) / size,
                len(set(words)) / n,
                sum(map(bytes.__eq__, words, words[1:])) / n,
                len(DIGIT.findall(line)) / size,
                len(line) / n,
                float(repeated[at : at + n].mean()),
                float(line.rstrip()[-1:] in ".,;:"),
                float(line in seen),
            )
        )
        seen.add(line)
        at += n
    values = np.array(rows, float).reshape(-1, len(BINS))
    return np.stack([np.searchsorted(e, values[:, k]) + s for k, (e, s) in enumerate(zip(EDGES, STARTS, strict=True))], axis=1)


@dataclass
class Field:
    emission: np.ndarray  # (WIDTH, 2)
    transition: np.ndarray  # (2, 2), from row to column
    start: np.ndarray  # (2,)


def viterbi(field: Field, features: np.ndarray) -> np.ndarray:
    """The best labels of one document's lines; ties go to content."""
    scores = field.emission[features].sum(axis=1).tolist()
    (bb, bc), (cb, cc) = field.transition.tolist()
    b, c = field.start[0], field.start[1]
    back = []
    for k, (eb, ec) in enumerate(scores):
        if k:
            from_b, from_c = b + bb > c + cb, b + bc > c + cc
            b, c = max(b + bb, c + cb) + eb, max(b + bc, c + cc) + ec
            back.append((from_b, from_c))
        else:
            b, c = b + eb, c + ec
    label = BOILERPLATE if b > c else CONTENT
    path = [label]
    for from_b, from_c in reversed(back):
        label = BOILERPLATE if (from_b if label == BOILERPLATE else from_c) else CONTENT
        path.append(label)
    return np.array(path[::-1], np.int8)


def train(features: np.ndarray, counts: np.ndarray, labels: np.ndarray, rounds: int = 60, rate: float = 0.5, decay: float = 1e-3) -> Field:
    """Maximum likelihood of the labels by full-batch Adagrad, forward and backward over all documents at once.

    ``features``: one row of bins per line, document after document; ``counts``: lines
    of each document; ``labels``: one per line. Without lines all weights are 0.
    """
    emission, transition, start = np.zeros((WIDTH, 2)), np.zeros((2, 2)), np.zeros(2)
    if not len(features):
        return Field(emission, transition, start)
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    first = (np.cumsum(counts) - counts)[order]
    lengths = counts[order]
    alive = [int((lengths > t).sum()) for t in range(int(lengths.max()))]
    gold = np.zeros((len(features), 2))
    gold[np.arange(len(features)), labels] = 1
    follows = np.ones(len(features), bool)
    follows[first] = False
    steps = np.flatnonzero(follows)
    gold_pairs = np.zeros((2, 2))
    np.add.at(gold_pairs, (labels[steps - 1], labels[steps]), 1)
    total = len(features)
    squares = [np.full(x.shape, 1e-8) for x in (emission, transition, start)]
    for _ in range(rounds):
        score = emission[features].sum(axis=1)
        forward, backward = np.zeros((total, 2)), np.zeros((total, 2))
        forward[first] = start + score[first]
        for t in range(1, len(alive)):
            at = first[: alive[t]] + t
            forward[at] = np.logaddexp.reduce(forward[at - 1][:, :, None] + transition, axis=1) + score[at]
        for t in range(len(alive) - 1, 0, -1):
            at = first[: alive[t]] + t
            backward[at - 1] = np.logaddexp.reduce(transition + (score[at] + backward[at])[:, None, :], axis=2)
        whole = np.logaddexp.reduce(forward + backward, axis=1, keepdims=True)
        node = np.exp(forward + backward - whole)
        pair = np.exp(forward[steps - 1][:, :, None] + transition + (score[steps] + backward[steps])[:, None, :] - whole[steps][:, :, None])
        miss = node - gold
        grads = [
            np.stack([np.bincount(features.ravel(), np.repeat(miss[:, k], features.shape[1]), minlength=WIDTH) for k in (0, 1)], axis=1) / total,
            (pair.sum(axis=0) - gold_pairs) / total,
            miss[first].sum(axis=0) / total,
        ]
        for x, g, q in zip((emission, transition, start), grads, squares, strict=True):
            g += decay * x
            q += g**2
            x -= rate * g / np.sqrt(q)
    return Field(emission, transition, start)


def fit(rows: DataFrame, text_col: str = "text", label_col: str = "quality") -> Field:
    """A field from a bounded sample of labelled rows (:func:`common.labelled_sample`)."""
    schema = T.StructType(
        [
            T.StructField("label", T.IntegerType()),
            T.StructField("lines", T.IntegerType()),
            T.StructField("features", T.ArrayType(T.IntegerType())),
        ]
    )

    def step(texts, labels):
        found = []
        for text in texts:
            base, lines = measure(text)
            found.append(line_features(lines, base.repeated))
        return [int(x > 0) for x in labels], [len(f) for f in found], [f.ravel().tolist() for f in found]

    table = map_rows(rows.filter(F.col(label_col).isNotNull()), [text_col, label_col], step, schema).toArrow().combine_chunks()
    counts = table["lines"].to_numpy()
    features = table["features"].combine_chunks().flatten().to_numpy().reshape(-1, len(BINS))
    return train(features, counts, np.repeat(table["label"].to_numpy(), counts))


def judge(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", content_share: float = CONTENT_SHARE) -> DataFrame:
    """Per row: id, base counts, ``base_failed``, ``content_share`` (of words) and ``kept``.

    Words are runs without ASCII white space. A null or wordless text has counts 0 and
    content share 0 and fails. ``kept``: the base rules hold and the content share is
    at least ``content_share``.
    """
    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = T.StructType(
        [
            docs.schema[id_col],
            *(T.StructField(c, T.LongType()) for c in longs),
            T.StructField("base_failed", T.BooleanType()),
            T.StructField("content_share", T.DoubleType()),
            T.StructField("kept", T.BooleanType()),
        ]
    )

    def step(ids, texts):
        rows = []
        for text in texts:
            base, lines = measure(text)
            share = 0.0
            if lines:
                path = viterbi(field, line_features(lines, base.repeated))
                share = float(np.dot(path, [len(w) for _, w in lines]) / base.n_words)
            rows.append((*(getattr(base, c) for c in longs), base.failed, share, not base.failed and share >= content_share))
        return ids, *map(list, zip(*rows, strict=True))

    return map_rows(docs, [id_col, text_col], step, schema)


def mark_lines(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, line, content``: the label of every line that holds a word, in order."""
    schema = T.StructType(
        [docs.schema[id_col], T.StructField("line", T.StringType()), T.StructField("content", T.BooleanType())]
    )

    def step(ids, texts):
        rows = []
        for i, text in zip(ids, texts, strict=True):
            base, lines = measure(text)
            if lines:
                path = viterbi(field, line_features(lines, base.repeated))
                rows += [(i, line, bool(mark)) for (line, _), mark in zip(lines, path, strict=True)]
        return tuple(map(list, zip(*rows, strict=True))) if rows else ([], [], [])

    return map_rows(docs, [id_col, text_col], step, schema)
