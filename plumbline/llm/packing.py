"""Cost-balanced packing of token sequences.

A sequence of ``n`` tokens costs ``linear * n + quadratic * n^2`` per piece (a piece
attends to itself only). Documents are taken in descending cost; each goes to the
sequence of the lowest cost that has room for it. One that fits nowhere whole is cut:
its pieces fill lowest-cost sequences. The sequences of a block are as many as its
tokens need, the last ones at powers of two, so that no token is padding.

Where a document is tokenised it is packed: a task reads its documents once, collects
blocks of about ``block_tokens`` tokens and packs each block on its own. Nothing is
shuffled, a lost task is repeated alone, and memory is one block and one document,
whatever the input.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.llm import common

CAPACITY = 2048
END_ID = 1
BLOCK_TOKENS = 1 << 20
CACHE_WORDS = 800_000
LINEAR, QUADRATIC = 1.0, 1.0 / 1024

# A text of these characters alone is split as the tokenizer's own pattern splits it,
# written for ASCII and Latin letters: contractions, letters, digits, other signs,
# white space (the last one goes with the word that follows).
SIMPLE = re.compile(r"[\t\n\r -~À-ÖØ-öø-ſ]*")
SPLIT = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[A-Za-zÀ-ſ]+| ?[0-9]+| ?[^\sA-Za-zÀ-ſ0-9]+|\s+(?!\S)|\s+")

SPACED = re.compile(r" [A-Za-zÀ-ÖØ-öø-ſ]+")


class Encoder:
    """Ids of the ``tokenizers`` library, word by word.

    Byte-level merges never cross the library's word split, so a text is its words'
    ids in order. Words are kept in a bounded cache as ready 32-bit ids; new ones, all
    texts beyond Latin letters and those that hold the string of an added token, which
    the library cuts out before it splits words, are given to the library.
    """

    def __init__(self, tokenizer_file: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has one task per core already
        self.library = Tokenizer.from_file(tokenizer_file)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {}

    def _holds_added(self, text: str) -> bool:
        return any(content in text for content in self.added)

    def _whole(self, texts: list[str]) -> list[bytes]:
        coded = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(c.ids, "<u4").tobytes() for c in coded]

    def _in_one(self, words: list[str]) -> list[bytes]:
        """Words that begin with a space, as one text that the library splits into just these words."""
        coded = self.library.encode("".join(words), add_special_tokens=False)
        ids, owner = np.array(coded.ids, "<u4"), np.array(coded.word_ids, np.int64)
        starts = np.searchsorted(owner, np.arange(len(words) + 1)).tolist()
        return [ids[a:b].tobytes() for a, b in zip(starts, starts[1:])]

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of one whole text."""
        if self._holds_added(text) or not SIMPLE.fullmatch(text):
            return self._whole([text])[0]
        words = SPLIT.findall(text)
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            pass
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        fresh = sorted(set(words).difference(self.words))
        spaced = [w for w in fresh if SPACED.fullmatch(w)]
        other = [w for w in fresh if not SPACED.fullmatch(w)]
        self.words.update(zip(other, self._whole(other), strict=True))
        self.words.update(zip(spaced, self._in_one(spaced), strict=True))
        return b"".join(map(self.words.__getitem__, words))


def capacities(tokens: int, capacity: int = CAPACITY) -> np.ndarray:
    """Full sequences, and the rest as descending powers of two: they hold exactly ``tokens``."""
    rest = tokens % capacity
    tail = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.array([capacity] * (tokens // capacity) + tail, np.int64)


def pack(lengths: np.ndarray, capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """``(document, start, length, sequence, offset)`` of every piece; documents without tokens get none.

    Ties in length go to the earlier document, ties in cost to the earlier sequence.
    """
    room = capacities(int(lengths.sum()), capacity)
    used, cost = np.zeros(len(room), np.int64), np.zeros(len(room))
    pieces = []

    def put(document: int, start: int, n: int, at: int) -> None:
        pieces.append((document, start, n, at, int(used[at])))
        used[at] += n
        room[at] -= n
        cost[at] += linear * n + quadratic * n * n

    for document in np.argsort(-lengths, kind="stable").tolist():
        start, left = 0, int(lengths[document])
        while left:
            fits = np.flatnonzero(room >= min(left, capacity))
            if not len(fits):
                fits = np.flatnonzero(room)
            at = int(fits[np.argmin(cost[fits])])
            n = min(left, int(room[at]))
            put(document, start, n, at)
            start, left = start + n, left - n
    return pieces


def _schema(id_field: T.StructField) -> T.StructType:
    longs = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    return T.StructType(
        [id_field, *(T.StructField(c, T.LongType()) for c in longs), T.StructField("ids", T.BinaryType())]
    )


def pack_documents(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    block_tokens: int = BLOCK_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``.

    Every document is its ids and ``end_id`` (a null or empty text: ``end_id`` alone).
    ``sequence_id`` holds the partition and a counter, so it is unique and the same
    when a task is repeated. ``ids`` are little-endian 32-bit ids of the piece, null
    unless ``with_ids``. Rows with repeated or null ids are packed like any other.
    """
    schema = _schema(docs.schema[id_col])
    arrow = to_arrow_schema(schema)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = common.per_worker(f"packing {tokenizer_file}", lambda: Encoder(tokenizer_file))
        base = TaskContext.get().partitionId() << 32
        block, held, sequences = [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal sequences, held
            lengths = np.array([len(ids) // 4 for _, ids in block], np.int64)
            rows = []
            for document, start, n, at, offset in pack(lengths, capacity):
                doc_id, ids = block[document]
                part = ids[4 * start : 4 * (start + n)]
                rows.append((doc_id, start, n, crc32(part), int(lengths[document]), base + sequences + at, offset, part if with_ids else None))
            sequences += len(capacities(int(lengths.sum()), capacity))
            block.clear()
            held = 0
            columns = zip(*rows, strict=True) if rows else [[] for _ in arrow]
            return pa.RecordBatch.from_arrays(
                [pa.array(values, type=f.type) for values, f in zip(columns, arrow, strict=True)], schema=arrow
            )

        for batch in batches:
            for begin in range(0, batch.num_rows, common.ROWS):
                part = batch.slice(begin, common.ROWS)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = encoder.encode(text or "") + end
                    block.append((doc_id, ids))
                    held += len(ids) // 4
                    if held >= block_tokens:
                        yield flush()
        if block:
            yield flush()

    return docs.select(id_col, text_col).mapInArrow(run, schema)
