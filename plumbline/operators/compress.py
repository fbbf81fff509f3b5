"""Compression of texts and messages to a token budget, by keeping segments."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import skew
from plumbline.functions import text as T
from plumbline.functions.text import r6
from plumbline.operators import grounding as G
from plumbline.session import materialise

# Terms worth keeping are emails and tokens with a digit.
PRESERVED = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}|[\p{L}\p{N}]*[0-9][\p{L}\p{N}]*"

WEIGHED = "total double, rest array<string>"


def preserved_terms(text: Column) -> Column:
    """Sorted distinct terms that mark a segment as worth keeping."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(PRESERVED), F.lit(0))))


def has_preserved(text: Column) -> Column:
    """True with a preserved term: any digit is part of one, without a digit it has an @."""
    return text.rlike("[0-9]") | (text.contains("@") & text.rlike(PRESERVED))


def segments(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys, ix, text, char_start, char_end`` of each text."""
    return T.piece_rows(df, keys, text, T.SEGMENT_END)


def keep_scores(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Segments with ``n_tokens`` and ``keep_score``.

    The score is the mean idf of the segment's distinct terms (over all segments),
    plus 1 with a preserved term; a later exact repeat in the same text scores 0.
    """
    ids = [*keys, "ix"]
    # cut once: frequencies, weights and repeats are all read from the written segments
    pieces = materialise(segments(df, keys, text).withColumn(G.TERMS, T.distinct_tokens(F.col("text"))), "segments")
    total = pieces.count()
    frequency = materialise(G.document_frequency(T.exploded(pieces, [], F.col(G.TERMS), "term")), "frequencies")
    known = frequent_weights(frequency, total)
    placed = pieces.withColumn("_w", known(F.col(G.TERMS))).withColumn("_n", F.size(G.TERMS))
    # as in a join, a text without a whole key has no scores
    named = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    rare = (
        T.exploded(placed.filter(named), ids, F.col("_w.rest"), "term")
        .join(frequency, "term")
        .groupBy(*ids)
        .agg(F.sum(G.idf(F.col("df"), F.lit(total))).alias("_rare"))
    )
    # segments and the sums of their rare terms travel by text, and windows need no shuffle after it
    both = placed.filter(named).select(*ids, "text", "char_start", "char_end", "_n", F.col("_w.total").alias("_sum")).unionByName(
        rare.withColumnRenamed("_rare", "_sum"), allowMissingColumns=True
    )
    one = Window.partitionBy(*ids)
    same = Window.partitionBy(*keys, "text").orderBy("ix")
    repeat = F.row_number().over(same) > 1
    return (
        both.repartition(*keys)
        .withColumn("_mean", F.sum("_sum").over(one) / F.sum("_n").over(one))
        .filter(F.col("text").isNotNull())
        .withColumn("is_repeat", repeat)
        .select(
            *ids,
            "text",
            "char_start",
            "char_end",
            T.token_count(F.col("text")).alias("n_tokens"),
            "is_repeat",
            r6(
                F.when(F.col("is_repeat"), 0.0).otherwise(
                    F.col("_mean") + has_preserved(F.col("text")).cast("int")
                )
            ).alias("keep_score"),
        )
    )


def frequent_weights(frequency: DataFrame, total: int) -> Callable[[Column], Column]:
    """From an array of terms to the sum of the weights of the frequent ones (``total``) and the other terms (``rest``).

    Terms that hold more than one row in 10,000 are known to every task: fewer than
    10,000 terms, whatever the input.
    """
    hot = skew.frequent(frequency, "term", "df").collect()
    shared = frequency.sparkSession.sparkContext.broadcast(([r["term"] for r in hot], [r["df"] for r in hot]))

    @F.arrow_udf(WEIGHED)
    def weighed(lists: pa.Array) -> pa.Array:
        names, df = pa.array(shared.value[0], pa.string()), np.array(shared.value[1], np.float64)
        weights = np.append(np.log((total + 1) / (df + 1)) + 1, 0.0)
        terms, row = lists.flatten(), np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
        at = pc.fill_null(pc.index_in(terms, value_set=names), len(names)).to_numpy()
        other = at == len(names)
        ends = np.append(0, np.cumsum(np.bincount(row[other], minlength=len(lists))))
        rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), terms.filter(pa.array(other)))
        return pa.StructArray.from_arrays([pa.array(np.bincount(row, weights[at], len(lists))), rest], ["total", "rest"])

    return weighed


def choose_segments(scored: DataFrame, keys: list[str], target_token_ratio: float) -> DataFrame:
    """Mark the segments to keep: best first while they fit, the best always."""
    ranked = Window.partitionBy(*keys).orderBy(F.desc("keep_score"), F.asc("ix"))
    upto = ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys)
    return (
        scored.withColumn("_running", F.sum("n_tokens").over(upto))
        .withColumn("_rank", F.row_number().over(ranked))
        .withColumn("_budget", F.floor(F.sum("n_tokens").over(whole) * target_token_ratio))
        .withColumn("kept", (F.col("_rank") == 1) | (F.col("_running") <= F.col("_budget")))
        .drop("_running", "_rank", "_budget")
    )


def compress_text(
    df: DataFrame, keys: list[str], text: str = "text", target_token_ratio: float = 0.5
) -> DataFrame:
    """Compressed text per row with its statistics, kept segments in original order.

    A text without a token stays as it is (null: empty) with counts 0 and null ratios.
    """
    chosen = choose_segments(keep_scores(df, keys, text), keys, target_token_ratio)
    kept_text = F.array_join(
        F.transform(
            F.array_sort(F.collect_list(F.when(F.col("kept"), F.struct("ix", "text")))),
            lambda s: s["text"],
        ),
        " ",
    )
    before, after = F.col("tokens_before"), F.col("tokens_after")
    bare = df.filter(~T.has_token(F.coalesce(F.col(text), F.lit("")))).select(
        *keys,
        F.coalesce(F.col(text), F.lit("")).alias("compressed_text"),
        *(F.lit(0).cast("bigint").alias(c) for c in ("tokens_before", "tokens_after", "spans_total", "spans_kept", "spans_repeated")),
    )
    counted = (
        chosen.groupBy(*keys)
        .agg(
            kept_text.alias("compressed_text"),
            F.sum("n_tokens").alias("tokens_before"),
            F.sum(F.when(F.col("kept"), F.col("n_tokens")).otherwise(0)).alias("tokens_after"),
            F.count(F.lit(1)).alias("spans_total"),
            F.count_if("kept").alias("spans_kept"),
            F.count_if("is_repeat").alias("spans_repeated"),
        )
    )
    kept_share = F.try_divide(after, before)
    return counted.unionByName(bare).withColumns(
        {
            "compression_ratio": r6(kept_share),
            "compression_percentage": r6((1 - kept_share) * 100),
            "tokens_saved": before - after,
        }
    )


def compress_messages(
    turns: DataFrame, target_token_ratio: float = 0.5
) -> DataFrame:
    """Each message compressed on its own, roles and order kept; system messages
    and messages without a token stay as they are."""
    keys = ["conv_id", "turn"]
    squeezed = compress_text(
        turns.filter(F.col("role") != "system"), keys, "text", target_token_ratio
    ).select(*keys, "compressed_text", "tokens_before", "tokens_after")
    n = T.token_count(F.col("text"))
    return turns.join(squeezed, keys, "left").select(
        *keys,
        "role",
        F.coalesce("compressed_text", "text").alias("content"),
        F.coalesce("tokens_before", n).alias("tokens_before"),
        F.coalesce("tokens_after", n).alias("tokens_after"),
    )
