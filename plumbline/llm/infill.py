"""Fill-in-the-middle texts: prefix, middle and suffix in the order a model learns them.

A batch goes through ``pyarrow.compute``: texts become lists of units (code points),
the lists are flattened with the index of their text, units get ordinals, are filtered
by the part they belong to, and each part's lists are rebuilt and joined.

Tasks: no shuffle. Texts are cut in slices of at most ``SLICE`` bytes and longer texts
in pieces of that length, so a task holds the units of one slice (about 60 bytes a
unit) besides the texts of its batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKER = "<[PSM]>"
SLICE = 1 << 19
PLAIN, SUFFIX_FIRST, PREFIX_FIRST = "plain", "spm", "psm"


def _offsets(lengths: pa.Array) -> pa.Array:
    return pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(lengths.cast(pa.int64()))])


def units(texts: pa.LargeStringArray) -> pa.LargeListArray:
    """The code points of each text (no nulls) as a list, over the texts' own bytes."""
    texts = pa.concat_arrays([texts.slice(0, 0), texts])  # offsets from 0
    data = texts.buffers()[2] or pa.py_buffer(b"")
    size = texts.buffers()[1] and int(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset + len(texts)]) or 0
    raw = pa.Array.from_buffers(pa.uint8(), size, [None, data])
    lead = pc.not_equal(pc.bit_wise_and(raw, pa.scalar(0xC0, pa.uint8())), pa.scalar(0x80, pa.uint8()))
    starts = pc.indices_nonzero(lead).cast(pa.int64())
    ends = pa.concat_arrays([starts, pa.array([size], pa.int64())])
    points = pa.LargeStringArray.from_buffers(len(starts), ends.buffers()[1], data)
    return pa.LargeListArray.from_arrays(_offsets(pc.utf8_length(texts)), points)


def cut(texts: pa.LargeStringArray, low: pa.Array, high: pa.Array) -> list[pa.Array]:
    """Prefix, middle and suffix of each text: units before ``low``, from there to ``high``, and the rest."""
    lists = units(texts)
    flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    ordinals = pc.subtract(pa.array(np.arange(len(flat))), pc.take(lists.offsets, parents))
    before = pc.less(ordinals, pc.take(low, parents))
    after = pc.greater_equal(ordinals, pc.take(high, parents))
    n = pc.list_value_length(lists).cast(pa.int64())
    parts = (
        (before, low),
        (pc.invert(pc.or_(before, after)), pc.subtract(high, low)),
        (after, pc.subtract(n, high)),
    )
    rebuilt = [pa.LargeListArray.from_arrays(_offsets(length), pc.filter(flat, role)) for role, length in parts]
    return [pc.binary_join(x, pa.scalar("", pa.large_string())) for x in rebuilt]


def _cut_long(text: str, low: int, high: int) -> list[pa.Array]:
    """:func:`cut` of one text piece by piece."""
    step = SLICE // 4
    found: list[list[str]] = [[], [], []]
    for base in range(0, len(text), step):
        piece = text[base : base + step]
        a, b = (min(max(x - base, 0), len(piece)) for x in (low, high))
        parts = cut(pa.array([piece], pa.large_string()), pa.array([a], pa.int64()), pa.array([b], pa.int64()))
        for out, part in zip(found, parts, strict=True):
            out.append(part[0].as_py())
    return [pc.binary_join(pa.array([x], pa.large_list(pa.large_string())), pa.scalar("", pa.large_string())) for x in found]


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``SLICE`` bytes; a longer text is alone in its range."""
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > SLICE:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def _modulo(a: pa.Array, b) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _transform(texts: pa.LargeStringArray, h: list[pa.Array], rate: int, suffix_first: int) -> list[pa.Array]:
    n = pc.utf8_length(texts).cast(pa.int64())
    whole = pc.or_(pc.equal(n, 0), pc.or_(pc.match_substring_regex(texts, MARKER), pc.greater_equal(_modulo(h[2], 100), rate)))
    swapped = pc.less(_modulo(h[3], 100), suffix_first)
    form = pc.if_else(whole, PLAIN, pc.if_else(swapped, SUFFIX_FIRST, PREFIX_FIRST))
    places = pc.add(n, 1)
    first, second = _modulo(h[0], places), _modulo(h[1], places)
    low, high = pc.min_element_wise(first, second), pc.max_element_wise(first, second)
    if len(texts) == 1 and pc.binary_length(texts)[0].as_py() > SLICE:
        prefix, middle, suffix = _cut_long(texts[0].as_py(), low[0].as_py(), high[0].as_py())
    else:
        prefix, middle, suffix = cut(texts, low, high)
    mark_p, mark_s, mark_m, gap = (pa.scalar(x, pa.large_string()) for x in (PREFIX, SUFFIX, MIDDLE, ""))
    spm = pc.binary_join_element_wise(mark_s, suffix, mark_p, prefix, mark_m, middle, gap)
    psm = pc.binary_join_element_wise(mark_p, prefix, mark_s, suffix, mark_m, middle, gap)
    none = pa.scalar(None, pa.int64())
    return [
        n,
        form,
        pc.if_else(whole, none, low),
        pc.if_else(whole, none, pc.subtract(high, low)),
        pc.if_else(whole, texts, pc.if_else(swapped, spm, psm)),
    ]


def draws(id_col: str, seed: str = "1") -> list[Column]:
    """Four unsigned 32-bit draws of a row, from the SHA-256 of the seed and its id (null: empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def transform(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = 90, suffix_first: int = 20, seed: str = "1"
) -> DataFrame:
    """``id_col, n, form, prefix_chars, middle_chars, output`` per row of ``docs``.

    ``rate`` of 100 texts are cut at two places drawn from their id and put together
    with markers, ``suffix_first`` of 100 of these with the suffix in front (``spm``),
    the others prefix first (``psm``). Empty and null texts and texts that hold a
    marker stay ``plain``, as they are. Rows are kept as they are: repeated rows give
    equal rows, a null id draws like an empty one, an empty table gives an empty one.
    """
    schema = T.StructType(
        [
            docs.schema[id_col],
            T.StructField("n", T.LongType()),
            T.StructField("form", T.StringType()),
            T.StructField("prefix_chars", T.LongType()),
            T.StructField("middle_chars", T.LongType()),
            T.StructField("output", T.StringType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            for start, end in _slices(pc.binary_length(texts).to_numpy(zero_copy_only=False)):
                rows = batch.slice(start, end - start)
                out = _transform(texts.slice(start, end - start), rows.columns[2:], rate, suffix_first)
                arrays = [x.cast(f.type) for x, f in zip([rows.column(0), *out], arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return docs.select(id_col, text_col, *draws(id_col, seed)).mapInArrow(run, schema)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that ``output`` was made of."""
    part = F.split(F.col(output), MARKER, -1)
    return (
        F.when(F.col(form) == PREFIX_FIRST, F.concat(part[1], part[3], part[2]))
        .when(F.col(form) == SUFFIX_FIRST, F.concat(part[2], part[3], part[1]))
        .otherwise(F.col(output))
    )
