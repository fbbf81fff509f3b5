"""SentencePiece (BPE) encoding and decoding by vectorised merge rounds.

Symbols of many words lie in one flat numpy array. A round finds the best rank among
the neighbouring pairs of each word (a segmented minimum), merges all leftmost
occurrences of that pair at once and compacts the array; rounds go on until no word
has a pair that is a piece.

The library merges one pair at a time, always the best, the leftmost on ties. Merging
all of one rank at once gives the same unless a merge makes a pair of the same or a
better rank. That is seen when it happens, and such a word is merged again one
pair at a time.

No piece has a space mark behind another character, so a text is cut into words
before each run of space marks, and a word's ids are the same wherever it stands.
Distinct words are encoded once per cache fill and Python worker.
"""

from __future__ import annotations

import heapq
import re
from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plumbline.llm.common import map_rows, per_worker

SPACE = "▁"
# runs of space marks with the word behind them; a line end never merges
SPLIT = re.compile(r" *[^ \n]+|\n| +")
CACHE_WORDS = 500_000
NO_RANK = np.iinfo(np.int64).max


class Vocabulary:
    """Pieces, ranks and pair table of a public model file with byte fallback and no normalisation."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece holds a space mark behind another character")
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.end_id = model.eos_id()
        # equal scores share a rank: the leftmost pair wins among them
        scores = sorted({model.get_score(i) for i in plain}, reverse=True)
        place = {s: r for r, s in enumerate(scores)}
        rank_of = {i: place[model.get_score(i)] for i in plain}
        left, right, whole = [], [], []
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    whole.append(i)
        self.base = n + 1  # id n: a character that is no piece
        keys = np.array(left, np.int64) * self.base + np.array(right, np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], NO_RANK)
        self.merged = np.append(np.array(whole, np.int64)[order], -1)
        self.ranks = np.array([rank_of[i] for i in self.merged[:-1].tolist()] + [NO_RANK], np.int64)
        self.pair = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.merged.tolist(), strict=True), strict=True))
        self.raw = [self._raw(model, i) for i in range(n)]

    def _raw(self, model, i: int) -> bytes:
        """The bytes that a piece stands for."""
        if model.is_byte(i):
            return bytes([int(self.pieces[i][3:5], 16)])
        if model.is_control(i):
            return b""
        if model.is_unknown(i):
            return " ⁇ ".encode()
        return self.pieces[i].replace(SPACE, " ").encode()

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Position of each pair in the pair table, of the last entry where it is none."""
        keys = left * self.base + right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, at, len(self.keys) - 1)


def merge_words(vocabulary: Vocabulary, words: list[str]) -> list[bytes]:
    """The 32-bit ids of each non-empty word, characters that are no piece as their bytes' ids."""
    none = len(vocabulary.pieces)
    ids = vocabulary.ids
    symbols = np.array([ids.get(c, none) for w in words for c in w], np.int64)
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    done: list[bytes] = [b""] * len(words)
    lacking = set(owner[symbols == none].tolist())
    last_rank = np.full(len(words), -1, np.int64)
    again: set[int] = set()
    pair = vocabulary.look_up(symbols[:-1], symbols[1:])
    pair = np.append(pair, len(vocabulary.keys) - 1) if len(symbols) else pair
    inner = np.append(owner[1:] == owner[:-1], False)
    while len(symbols):
        rank = np.where(inner, vocabulary.ranks[pair], NO_RANK)
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        best = np.minimum.reduceat(rank, starts)
        names = owner[starts]
        ended = best == NO_RANK
        # words that have no pair left, or must be merged one pair at a time
        odd = ~ended & (best <= last_rank[names])
        if odd.any():
            again.update(names[odd].tolist())
        leave = ended | odd
        sizes = np.diff(np.append(starts, len(symbols)))
        if leave.any():
            full = symbols[np.repeat(ended, sizes)].astype("<i4").tobytes()
            ends = (4 * np.cumsum(sizes[ended])).tolist()
            for k, a, b in zip(names[ended].tolist(), [0, *ends], ends):
                done[k] = full[a:b]
            keep = ~np.repeat(leave, sizes)
            symbols, owner, pair, inner, rank = symbols[keep], owner[keep], pair[keep], inner[keep], rank[keep]
            best, sizes, names = best[~leave], sizes[~leave], names[~leave]
            if not len(symbols):
                break
        last_rank[names] = best
        hit = rank == np.repeat(best, sizes)
        # in a row of overlapping hits every other one counts, from the left
        at = np.flatnonzero(hit)
        fresh = np.append(True, np.diff(at) > 1)
        run = np.flatnonzero(fresh)
        order = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
        at = at[order % 2 == 0]
        symbols[at] = vocabulary.merged[pair[at]]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        changed = np.zeros(len(symbols), bool)
        changed[at] = True
        before = at[at > 0] - 1
        gone = ~keep[before]
        changed[np.where(gone, before - 1, before)] = True
        inner[at] = inner[at + 1]
        symbols, owner, pair, inner, changed = symbols[keep], owner[keep], pair[keep], inner[keep], changed[keep]
        look = np.flatnonzero(changed & inner)
        pair[look] = vocabulary.look_up(symbols[look], symbols[look + 1])
    for k in again:
        done[k] = np.array(merge_one(vocabulary, words[k]), "<i4").tobytes()
    for k in lacking:
        missing = (c.encode() for c in words[k] if c not in ids)
        found = np.frombuffer(done[k], "<i4").tolist()
        spelled = [x for i in found for x in ([i] if i != none else [vocabulary.bytes[b] for b in next(missing)])]
        done[k] = np.array(spelled, "<i4").tobytes()
    return done


def merge_one(vocabulary: Vocabulary, word: str) -> list[int]:
    """One word, one pair at a time: the best rank first, the leftmost on ties."""
    none = len(vocabulary.pieces)
    ids: list[int | None] = [vocabulary.ids.get(c, none) for c in word]
    following = list(range(1, len(ids))) + [-1]
    previous = list(range(-1, len(ids) - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(a: int, b: int) -> None:
        if a >= 0 and b >= 0 and (found := vocabulary.pair.get(ids[a] * vocabulary.base + ids[b])):
            heapq.heappush(heap, (found[0], a, ids[a], ids[b]))

    for a in range(len(ids) - 1):
        offer(a, a + 1)
    while heap:
        _, a, x, y = heapq.heappop(heap)
        b = following[a]
        if ids[a] != x or b < 0 or ids[b] != y:
            continue
        ids[a], ids[b] = vocabulary.pair[x * vocabulary.base + y][1], None
        following[a] = following[b]
        if following[a] >= 0:
            previous[following[a]] = a
        offer(previous[a], a)
        offer(a, following[a])
    return [i for i in ids if i is not None]


class Codec:
    """Encodes and decodes texts; one per Python worker, with a bounded word cache."""

    def __init__(self, model_file: str) -> None:
        self.vocabulary = Vocabulary(model_file)
        self.words: dict[str, bytes] = {}  # 32-bit ids
        raw = self.vocabulary.raw
        self.flat = np.frombuffer(b"".join(raw), np.uint8)
        self.size = np.array([len(r) for r in raw], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.decimal = [str(i) for i in range(len(raw))]

    def _learn(self, fresh: list[str]) -> None:
        self.words.update(zip(fresh, merge_words(self.vocabulary, [w.replace(" ", SPACE) for w in fresh]), strict=True))

    def encode(self, texts: list[str | None], end: bool = True) -> list[np.ndarray]:
        """The ids of each text; null is an empty text. The end id comes last if asked for."""
        # the library puts one space before a text that is not empty; U+2581 is a space to it
        cut = [SPLIT.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        fresh = set().union(*cut).difference(self.words)
        if len(self.words) + len(fresh) > CACHE_WORDS:
            self.words.clear()
            fresh = set().union(*cut)
        self._learn(sorted(fresh))
        tail = np.array([self.vocabulary.end_id], "<i4").tobytes() if end else b""
        known = self.words.__getitem__
        return [np.frombuffer(b"".join(map(known, words)) + tail, "<i4") for words in cut]

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text of ids: control ids are nothing, bytes that are no UTF-8 become U+FFFD."""
        array = np.asarray(ids, np.int64)
        size = self.size[array]
        at = np.repeat(self.start[array] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        text = self.flat[at].tobytes()
        return (text[1:] if text[:1] == b" " else text).decode("utf-8", "replace")

    def digest(self, ids: np.ndarray) -> str:
        """SHA-256 of the decimal ids joined by one space."""
        return sha256(" ".join(map(self.decimal.__getitem__, ids.tolist())).encode()).hexdigest()


def _codec(model_file: str) -> Codec:
    return per_worker(f"pieces {model_file}", lambda: Codec(model_file))


BATCH = 100


def _batched(texts: list) -> list[list]:
    return [texts[i : i + BATCH] for i in range(0, len(texts), BATCH)]


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", end: bool = True) -> DataFrame:
    """``id_col, ids``: the ids of each whole text (null and empty: the end id alone)."""
    schema = T.StructType([docs.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def step(keys, texts):
        return keys, [ids for part in _batched(texts) for ids in _codec(model_file).encode(part, end)]

    return map_rows(docs, [id_col, text_col], step, schema)


def decode(encoded: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, text``: the text of each list of ids (null: an empty text)."""
    schema = T.StructType([encoded.schema[id_col], T.StructField("text", T.StringType())])

    def step(keys, lists):
        return keys, [_codec(model_file).decode(ids or []) for ids in lists]

    return map_rows(encoded, [id_col, ids_col], step, schema)


def round_trip(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256``: encoded, decoded and digested where it is read.

    The same as :func:`encode` and :func:`decode` one after the other, without
    carrying ids between them.
    """
    schema = T.StructType(
        [
            docs.schema[id_col],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def step(keys, texts):
        codec, counts, spelled, decoded = _codec(model_file), [], [], []
        for part in _batched(texts):
            for ids in codec.encode(part):
                counts.append(len(ids))
                spelled.append(codec.digest(ids))
                decoded.append(sha256(codec.decode(ids).encode()).hexdigest())
        return keys, counts, spelled, decoded

    return map_rows(docs, [id_col, text_col], step, schema)
