"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The
probability of a word is the sum over all ways to cut it into pieces, computed by the
forward algorithm; a text is the product of its words. Piece probabilities are learned
by expectation maximisation (forward-backward) from word counts per language.

The forward pass is vectorised over distinct words: every substring of up to the
longest piece is looked up by a rolling hash, then positions are walked once for all
words of a length class. Distinct words meet once per task and cache fill.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import crc_bucket, map_rows, per_worker

LETTERS = regex.compile(r"\p{L}+")  # letters by Unicode category, so no superscripts or fractions
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
CACHE_WORDS = 200_000
SPACE = "▁"
UNDETERMINED = "und"


def vocabulary(model_file: str) -> list[str]:
    """The plain pieces of a public sentencepiece model that hold letters only, lower-cased, in order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    found: dict[str, None] = {}
    for i in range(model.get_piece_size()):
        if model.is_byte(i) or model.is_control(i) or model.is_unknown(i):
            continue
        piece = model.id_to_piece(i).lower()
        if piece == SPACE or piece.removeprefix(SPACE).isalpha():
            found[piece] = None
    return list(found)


def _hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """The rolling hash of every window of ``length`` code points."""
    total = np.zeros(max(0, len(codes) - length + 1), np.uint64)
    for k in range(length):
        total = total * BASE + codes[k : k + len(total)]
    return total


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)


class Pieces:
    """Finds the vocabulary piece at every start and length of a list of words."""

    def __init__(self, pieces: list[str]) -> None:
        by_length: dict[int, list[tuple[int, int]]] = {}
        with np.errstate(over="ignore"):
            for i, piece in enumerate(pieces):
                by_length.setdefault(len(piece), []).append((int(_hashes(_codes(piece), len(piece))[0]), i))
        self.size = len(pieces)
        self.tables = {}
        for length, pairs in sorted(by_length.items()):
            keys, ids = zip(*sorted(pairs), strict=True)
            self.tables[length] = np.array(keys, np.uint64), np.array(ids, np.int64)

    def match(self, words: list[str]) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """Start of each word in the joined codes, and per length the piece id at each start.

        ``size`` stands for no piece. A single code point that is no piece gets id
        ``size + 1``, the unknown character.
        """
        codes = _codes("".join(words))
        starts = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(codes))
        found = []
        with np.errstate(over="ignore"):
            for length, (keys, ids) in ({1: (np.array([], np.uint64), np.array([], np.int64))} | self.tables).items():
                at = np.full(len(codes), self.size, np.int64)
                if len(codes) >= length and len(keys):
                    inside = np.flatnonzero(left >= length)
                    hashes = _hashes(codes, length)[inside]
                    slot = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                    hit = keys[slot] == hashes
                    at[inside[hit]] = ids[slot[hit]]
                if length == 1:
                    at[at == self.size] = self.size + 1
                found.append((length, at))
        return starts, found


def _walk(pieces: Pieces, words: list[str], probs: np.ndarray, counts: np.ndarray | None = None):
    """Log probability of each word per language; with ``counts`` also the expected piece counts.

    ``probs`` has ``size + 2`` rows: pieces, nothing (zero), unknown character. Long
    words are rescaled on the way; when learning they are not, and a word whose
    probability is below the smallest double teaches nothing.
    """
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    words = [words[i] for i in order]
    starts, found = pieces.match(words)
    lengths = np.diff(starts)
    n, width = len(words), probs.shape[1]
    longest = int(lengths.max(initial=0))
    alpha, scale = [np.ones((n, width))], np.zeros((n, width))
    log = np.zeros((n, width))
    alive = np.searchsorted(-lengths, -np.arange(longest + 1), side="right")  # words of at least that length
    for t in range(1, longest + 1):
        m = alive[t]
        now = np.zeros((m, width))
        for length, at in found:
            if length <= t:
                now += alpha[t - length][:m] * probs[at[starts[:m] + t - length]]
        if counts is None and now.size and now.min() < 1e-150:
            lift = np.where(now < 1e-150, 1e150, 1.0)  # all positions that are still needed are lifted together
            now *= lift
            for k in range(max(0, t - 16), t):
                alpha[k][:m] *= lift
            scale[:m] -= np.log(lift)
        alpha.append(now)
        if counts is None and t > 16:
            alpha[t - 17] = None
        done = alive[t + 1] if t < longest else 0
        if done < m:
            with np.errstate(divide="ignore"):
                log[done:m] = np.log(now[done:m]) + scale[done:m]
    result = np.empty((n, width))
    result[order] = log
    if counts is None:
        return result
    weights = counts[order]
    beta = {}
    expected = np.zeros_like(probs)
    for t in range(longest, -1, -1):
        m = alive[t]
        now = np.zeros((m, width))
        ends_here = alive[t + 1] if t < longest else 0
        final = alpha[t][ends_here:m]
        now[ends_here:] = np.divide(weights[ends_here:m], final, out=np.zeros_like(final), where=final > 0)
        for length, at in found:
            if t + length <= longest:
                k = alive[t + length]
                ids = at[starts[:k] + t]
                flow = beta[t + length][:k] * probs[ids]
                now[:k] += flow
                share = flow * alpha[t][:k]
                for j in range(width):
                    expected[:, j] += np.bincount(ids, share[:, j], minlength=len(expected))
        beta[t] = now
    return result, expected


@dataclass
class Model:
    langs: list[str]
    pieces: list[str]
    probs: np.ndarray  # (pieces + 2, langs)
    prior: np.ndarray


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample_docs: int) -> DataFrame:
    """About ``sample_docs`` documents of each language, chosen by a hash of id and text, equal rows once.

    Counts per language reach the driver: one row per language, not per document.
    """
    counts = {r[0]: r[1] for r in docs.groupBy(lang_col).count().collect()}
    if not counts:
        return docs
    share = F.create_map(
        *(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, sample_docs / n)))
    )
    chosen = F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 20)) < share[F.col(lang_col)] * float(1 << 20)
    return docs.filter(chosen).dropDuplicates([id_col, text_col, lang_col])


def fit(
    docs: DataFrame,
    model_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = 300,
    rounds: int = 3,
) -> Model:
    """Piece probabilities per language from whole texts of about ``sample_docs`` documents of each.

    Rows with a null language or text teach nothing. Only word counts of that bounded
    sample reach the driver.
    """
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(id_col, text_col, lang_col)
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("word", T.StringType())])

    def spell(texts: list[str], langs: list[str]):
        pairs = [(lang, w) for t, lang in zip(texts, langs, strict=True) for w in words_of(t)]
        return [p[0] for p in pairs], [p[1] for p in pairs]

    counted = (
        map_rows(_sample(known, id_col, text_col, lang_col, sample_docs), [text_col, lang_col], spell, schema)
        .groupBy("lang", "word")
        .count()
        .toArrow()
    )
    pieces = vocabulary(model_file)
    langs = sorted(set(counted["lang"].to_pylist()))
    words = sorted(set(counted["word"].to_pylist()))
    if not langs:
        return Model([], pieces, np.zeros((len(pieces) + 2, 0)), np.zeros(0))
    column = {lang: j for j, lang in enumerate(langs)}
    row = {w: i for i, w in enumerate(words)}
    counts = np.zeros((len(words), len(langs)))
    for lang, word, n in zip(*(counted[c].to_pylist() for c in ("lang", "word", "count")), strict=True):
        counts[row[word], column[lang]] = n
    finder = Pieces(pieces)
    probs = np.full((len(pieces) + 2, len(langs)), 1.0 / (len(pieces) + 1))
    probs[len(pieces)] = 0
    spelled = [SPACE + w for w in words]
    for _ in range(rounds):
        expected = np.zeros_like(probs)
        for i in range(0, len(words), 20_000):
            expected += _walk(finder, spelled[i : i + 20_000], probs, counts[i : i + 20_000])[1]
        expected += 0.01
        expected[len(pieces)] = 0
        probs = expected / expected.sum(axis=0)
    total = counts.sum(axis=0)
    return Model(langs, pieces, probs, np.log(total / total.sum()))


class Scorer:
    """Texts to languages with a bounded cache of word scores; one per Python worker and model."""

    def __init__(self, model: Model) -> None:
        self.model, self.finder = model, Pieces(model.pieces)
        self.clear()

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.langs)))

    def scored(self, words: list[str]) -> np.ndarray:
        """The summed log probabilities of one text's words."""
        return self.scores[np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))].sum(axis=0)

    def learn(self, texts: list[list[str]]) -> None:
        fresh = set().union(*texts).difference(self.row) if texts else set()
        if len(self.row) + len(fresh) > CACHE_WORDS:
            self.clear()
            fresh = set().union(*texts)
        fresh = sorted(fresh)
        parts = [self.scores]
        for i in range(0, len(fresh), 20_000):
            parts.append(_walk(self.finder, [SPACE + w for w in fresh[i : i + 20_000]], self.model.probs))
        self.row.update((w, len(self.scores) + i) for i, w in enumerate(fresh))
        self.scores = np.concatenate(parts)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [], []
        for i in range(0, len(texts), 100):
            words = [words_of(t) for t in texts[i : i + 100]]
            self.learn(words)
            for own in words:
                if not own or not self.model.langs:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                log = self.scored(own) + self.model.prior
                share = np.exp(log - log.max())
                best = int(np.argmax(share))
                langs.append(self.model.langs[best])
                scores.append(float(1.0 / share.sum()))
        return langs, scores


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the posterior of that language).

    ``und`` and 0 where the text is null or has no letter, or the model knows no
    language. Ties go to the language that sorts first. Repeated rows are scored one
    by one; all columns of ``docs`` are kept except earlier ones of these two names.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # vocabulary times languages, whatever the input
    key = uuid.uuid4().hex

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts):
        langs, scores = per_worker(key, lambda: Scorer(shared.value)).predict([t if isinstance(t, str) else None for t in texts])
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "__found")]
    return docs.select(*(F.col(f"`{c}`") for c in kept), predict(F.col(text_col)).alias("__found")).select(
        *(F.col(f"`{c}`") for c in kept), "__found.lang_pred", "__found.score"
    )


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of its id as text leaves 1 modulo 3 (false for a null id)."""
    return F.coalesce(crc_bucket(id_col, 3) == 1, F.lit(False))


def detect(spark: SparkSession, docs: DataFrame, model_file: str) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learned from the rows that are not held out."""
    marked = docs.select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = fit(marked.filter("not held_out"), model_file)
    return identify(marked.select("doc_id", "text", "held_out"), model).select(
        "doc_id", "held_out", "lang_pred", "score"
    )
