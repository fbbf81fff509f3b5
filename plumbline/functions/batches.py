"""Arrow batches of whole groups: rows of a group are neighbours, their terms packed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from plumbline.functions import text as T

NO_IX = -(1 << 63)  # stands for a unit without a number


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Batches of rows sorted by ``key`` as tables that end where a value of it ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key)
        start = values.index(values[-1]).as_py()  # the last value may go on in the next batch
        if start or (held and held[-1].column(key)[-1] != values[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, start)])
            held = []
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def cut(packed: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """All terms of packed rows and the row of each."""
    lists = pc.split_pattern(pc.fill_null(packed, "").combine_chunks(), T.MARK_OPEN)
    terms, row = lists.flatten(), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    filled = pc.not_equal(terms, "")
    return terms.filter(filled), row[filled.to_numpy(zero_copy_only=False)]


def changes(columns: list[pa.ChunkedArray]) -> np.ndarray:
    """A running number of each row's group, where rows of a group are neighbours."""
    new = np.zeros(len(columns[0]), bool)
    for column in columns:
        codes = column.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.cumsum(new)


def weigh(met: np.ndarray, size: int, known: np.ndarray, sought: np.ndarray, df: np.ndarray, total: int) -> np.ndarray:
    """Weights of ``met``, groups times ``size`` plus codes of terms. ``known`` has a weight per code,
    those of rare terms follow from ``df`` of what is ``sought`` in the same group."""
    weight = known[met % max(size, 1)]
    if len(sought):
        order = np.argsort(sought, kind="stable")
        sought, df = sought[order], df[order]
        place = np.minimum(np.searchsorted(sought, met), len(sought) - 1)
        same = sought[place] == met
        weight[same] = np.log((total + 1) / (df[place[same]] + 1.0)) + 1
    return weight


def known_weights(dictionary: pa.Array, terms: pa.Array, weights: np.ndarray, total: int) -> np.ndarray:
    """The weight of each term of ``dictionary``; one that is not among ``terms`` counts as unseen."""
    at = pc.index_in(dictionary, value_set=terms)
    by_term = np.full(len(dictionary), np.log(total + 1.0) + 1)
    by_term[at.is_valid().to_numpy(zero_copy_only=False)] = weights[at.drop_null().to_numpy()]
    return by_term
