"""Text primitives: tokens, segments and their offsets.

Texts are cut by built-in expressions; only the lengths of tokens go to a Python
worker, to be summed. Offsets count code points, start at 0 and end exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

# What counts as a token, a segment end, an atom end, blank space.
TOKEN = r"[\p{L}\p{N}]++"
GAP_AND_TOKEN = r"([^\p{L}\p{N}]*)([\p{L}\p{N}]+)"
SEGMENT_END = r"([.!?]+[ \t\r\n\f]+|\n+)"
ATOM_END = r"([,;:][ \t\r\n\f]+)"
LEADING_BLANK = r"^[ \t\r\n\f]+"
OUTER_BLANK = r"^[ \t\r\n\f]+|[ \t\r\n\f]+$"
MARK_OPEN = "\u0001"
MARK_CLOSE = "\u0002"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``.

    A plain reference inside a lambda would be evaluated again for every element
    once the optimizer merges projections.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def running_totals(lengths: Column) -> Column:
    """Inclusive running sums of an integer array, in blocks of about sqrt(n).

    One fold over the whole array would copy its growing result at every step;
    folding inside blocks keeps the copying small for arrays of any length.
    """

    def append(acc: Column, x: Column) -> Column:
        return F.concat(acc, F.array(F.element_at(acc, -1) + x))

    def blocked(arg: Column) -> Column:
        values, width = arg["v"], arg["w"]
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(values) - 1) / width).cast("int")),
            lambda b: F.slice(values, b * width + 1, width),
        )
        sums = F.transform(
            blocks, lambda p: F.aggregate(p, F.lit(0).cast("bigint"), lambda a, x: a + x)
        )
        carried = F.aggregate(sums, F.array(F.lit(0).cast("bigint")), append)
        return F.flatten(
            F.zip_with(
                blocks,
                F.slice(carried, 1, F.size(carried) - 1),
                lambda p, c: let(
                    F.aggregate(p, F.array(c), append), lambda t: F.slice(t, 2, F.size(t) - 1)
                ),
            )
        )

    def start(values: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(values))).cast("int"))
        return F.when(
            F.size(values) > 0, let(F.struct(values.alias("v"), width.alias("w")), blocked)
        ).otherwise(F.array().cast("array<bigint>"))

    return let(lengths, start)


@F.arrow_udf(ArrayType(LongType()))
def summed(lengths: pa.Array) -> pa.Array:
    """As :func:`running_totals` of arrays without nulls, a batch of rows at a time; not for use inside a lambda."""
    counts = lengths.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(counts)])
    totals = np.concatenate([[0], np.cumsum(lengths.flatten().to_numpy(zero_copy_only=False), dtype=np.int64)])
    ends = totals[1:] - np.repeat(totals[starts[:-1]], counts)
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ends), mask=lengths.is_null())


def tokens(text: Column) -> Column:
    """Lower-case tokens in order, repeats kept."""
    return F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), F.lower)


def distinct_tokens(text: Column) -> Column:
    """Lower-case tokens without repeats."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)))


def token_count(text: Column) -> Column:
    """Number of tokens."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("bigint")


def has_token(text: Column) -> Column:
    """True when the text holds at least one token."""
    return text.rlike(TOKEN)


def unmarked(text: Column) -> Column:
    """Blank out the two control characters used as markers; lengths stay equal."""
    return F.translate(text, MARK_OPEN + MARK_CLOSE, "  ")


def exploded(df: DataFrame, keys: list[str], array: Column, name: str) -> DataFrame:
    """``keys`` and one row per element of a computed array.

    A plain explode makes the optimizer add a filter on the array's size, which
    computes the array a second time; the outer form does not.
    """
    return df.select(*keys, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def packed(array: Column) -> Column:
    """An array of terms as one string, a fraction of its size where rows travel; empty arrays are null."""
    # nullif would get a name of its own in each plan, and equal shuffles would not be known as such
    return let(F.array_join(array, MARK_OPEN), lambda s: F.when(s != "", s))


def unpacked(text: Column) -> Column:
    """The array that :func:`packed` made a string of."""
    return F.split(text, MARK_OPEN)


def positions(df: DataFrame, keys: list[str], array: Column, ix: str, name: str) -> DataFrame:
    """As :func:`exploded`, with the 0-based position."""
    return (
        df.select(*keys, F.posexplode_outer(array).alias(ix, name))
        .filter(F.col(ix).isNotNull())
        .withColumn(ix, F.col(ix).cast("bigint"))
    )


def pieces(text: Column, boundary: str) -> Column:
    """Cut after each boundary match; the pieces concatenate back to the text."""
    return F.split(F.regexp_replace(unmarked(text), boundary, "$1" + MARK_OPEN), MARK_OPEN)


def trimmed(text: Column) -> Column:
    """Without leading and trailing blank space, line ends included."""
    return F.regexp_replace(text, OUTER_BLANK, "")


def token_parts(text: Column, totals: Callable[[Column], Column] = summed) -> Column:
    """Tokens in order as ``array<struct<token, end>>``; offsets are running sums inside the row.

    After rows were dealt by key, ``totals`` should be :func:`running_totals`: Spark does not know that
    rows stay where they are in a Python worker and would deal them again.
    """

    def found(group: int) -> Column:
        return F.regexp_extract_all(text, F.lit(GAP_AND_TOKEN), F.lit(group))

    return F.arrays_zip(found(2).alias("token"), totals(F.transform(found(0), F.length)).alias("end"))


def token_rows(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per token: ``keys, ix, token, char_start, char_end``.

    Neither texts nor tokens are shuffled.
    """
    return positions(df, keys, token_parts(F.col(text)), "ix", "part").select(
        *keys,
        "ix",
        F.col("part.token").alias("token"),
        (F.col("part.end") - F.length("part.token")).alias("char_start"),
        F.col("part.end").alias("char_end"),
    )


def piece_rows(
    df: DataFrame, keys: list[str], text: str, boundary: str, base: Column | None = None
) -> DataFrame:
    """One row per piece that holds a token: ``keys, ix, text, char_start, char_end``.

    Offsets are absolute (shifted by ``base``) and exclude outer blank space;
    ``ix`` counts the kept pieces from 0. Nothing is shuffled.
    """
    base = F.lit(0) if base is None else base

    cut = df.select(*keys, base.cast("bigint").alias("_base"), pieces(F.col(text), boundary).alias("_cut")).withColumn(
        "_ends", summed(F.transform("_cut", F.length))
    )
    placed = F.filter(
        F.arrays_zip(F.col("_cut").alias("raw"), F.col("_ends").alias("end")), lambda p: has_token(p["raw"])
    )
    raw = F.col("_part.raw")
    return (
        positions(cut, [*keys, "_base"], placed, "ix", "_part")
        .select(
            *keys,
            "ix",
            trimmed(raw).alias("text"),
            (
                F.col("_base") + F.col("_part.end") - F.length(F.regexp_replace(raw, LEADING_BLANK, ""))
            ).alias("char_start"),
        )
        .withColumn("char_end", F.col("char_start") + F.length("text"))
    )


def r6(value: Column) -> Column:
    """Six decimals: the precision every published score carries."""
    return F.round(value.cast("double"), 6)


def chunk_rows(df: DataFrame, keys: list[str], text: str, size: int) -> DataFrame:
    """Chunks of ``size`` tokens: ``keys, chunk_ix, char_start, char_end, n_tokens, text``."""
    chunks = (
        token_rows(df, keys, text)
        .groupBy(*keys, F.floor(F.col("ix") / size).alias("chunk_ix"))
        .agg(
            F.min("char_start").alias("char_start"),
            F.max("char_end").alias("char_end"),
            F.count(F.lit(1)).alias("n_tokens"),
        )
    )
    return chunks.join(df.select(*keys, F.col(text).alias("_text")), keys).select(
        *keys,
        "chunk_ix",
        "char_start",
        "char_end",
        "n_tokens",
        F.substring(
            F.col("_text"),
            (F.col("char_start") + 1).cast("int"),
            (F.col("char_end") - F.col("char_start")).cast("int"),
        ).alias("text"),
    )


def mean6(value: Column) -> Column:
    """Average of six-decimal scores as an exact integer sum of millionths.

    The result does not depend on the order in which partial sums arrive.
    """
    micros = F.sum(F.round(value * 1_000_000).cast("bigint"))
    return F.floor(F.try_divide(micros, F.count(value)) + 0.5) / 1_000_000
