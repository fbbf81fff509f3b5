"""Best documents by summed term weights, over posting lists cut in blocks.

Documents of like length are put in blocks, and the index holds a row per term and block
with the documents of the block that hold the term. What a document can score is bounded
by the terms its block holds, so only blocks whose bound reaches the best scores found
so far are opened. A term held by most documents is a row per block, not per document, and
its rows are spread over ``PARTS`` keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.functions.text import r6
from plumbline.session import materialise

BLOCK_DOCS = 16
PARTS = 8
# scores are published with six decimals; bounds leave room for that
MARGIN = 1e-5


def block_index(corpus: DataFrame, block_docs: int = BLOCK_DOCS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``term, block, docs`` of ``corpus(key, text)``: the documents of a block that hold a term.

    Blocks hold about ``block_docs`` documents whose numbers of distinct terms lie in
    the same quarter of a power of two: long documents hold most common terms and win
    often, and beside them short ones would never be ruled out.
    """
    cut = materialise(corpus.select(key, T.distinct_tokens(F.col(text)).alias("terms")), "cut").filter(F.size("terms") > 0)
    length = F.floor(4 * F.log2(F.size("terms"))).cast("int")
    sized = cut.withColumn("length", length)
    # a row per quarter power of two, whatever the input
    classes = sized.groupBy("length").agg(F.ceil(F.count(F.lit(1)) / block_docs).cast("bigint").alias("n"))
    first = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("base", F.coalesce(F.sum("n").over(first), F.lit(0)))
    placed = sized.join(F.broadcast(classes), "length").withColumn("block", F.col("base") + F.pmod(F.xxhash64(key), F.col("n")))
    return (
        T.exploded(placed, [key, "block"], F.col("terms"), "term")
        .groupBy("term", "block")
        .agg(F.collect_list(key).alias("docs"))
        .withColumn("part", F.pmod("block", F.lit(PARTS)))
    )


def term_statistics(index: DataFrame) -> DataFrame:
    """``term, df, blocks``: how many documents and blocks hold a term."""
    return index.groupBy("term").agg(F.sum(F.size("docs")).alias("df"), F.count(F.lit(1)).alias("blocks"))


def _everywhere(asked: DataFrame) -> DataFrame:
    """``asked`` once for each part that the rows of a term are spread over."""
    return asked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(PARTS - 1).cast("bigint"))))


def block_bounds(asked: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """``key, block, bound``: the summed weights of the terms that a block holds."""
    met = _everywhere(asked.select(key, "term", "weight")).join(index.select("term", "part", "block"), ["term", "part"])
    return met.groupBy(key, "block").agg(F.sum("weight").alias("bound"))


def opened(blocks: DataFrame, asked: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """``key, doc, score`` of the documents in ``blocks(key, block)`` that share a term."""
    met = blocks.join(asked.select(key, "term", "weight"), key).join(index.select("term", "block", "docs"), ["term", "block"])
    return met.select(key, "weight", F.explode("docs").alias("doc")).groupBy(key, "doc").agg(F.sum("weight").alias("score"))


def _best(rows: DataFrame, key: str, order: list[Column], limit: int) -> DataFrame:
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter(F.col("rank") <= limit)


def _reach(scores: DataFrame, key: str, limit: int) -> DataFrame:
    """``key, reach``: the ``limit``-th best score so far, 0 where there are fewer."""
    best = _best(scores, key, [F.desc("score"), F.asc("doc")], limit)
    return best.groupBy(key).agg(
        F.when(F.count(F.lit(1)) == limit, F.min("score")).otherwise(F.lit(0.0)).alias("reach")
    )


def winning_blocks(asked: DataFrame, index: DataFrame, key: str, limit: int) -> DataFrame:
    """``key, block`` of all blocks that can hold one of the ``limit`` best documents.

    The blocks of the largest bounds are opened first; the ``limit``-th best score found
    there is what the bound of any other block must reach.
    """
    bounds = materialise(block_bounds(asked, index, key), "bounds")
    start = _best(bounds, key, [F.desc("bound"), F.asc("block")], limit).select(key, "block")
    reach = _reach(opened(start, asked, index, key), key, limit)
    return bounds.join(reach, key).filter(F.col("bound") >= F.col("reach") - MARGIN).select(key, "block")


def top_documents(asked: DataFrame, index: DataFrame, key: str, limit: int) -> DataFrame:
    """``key, rank, doc, score``: the ``limit`` documents with the largest summed weights, exactly.

    ``asked`` holds ``key, term, weight``. ``index`` is read several times and should be a
    written table. Equal scores: the lesser document first.
    """
    # blocks of the first reach are opened again, so that no document counts twice
    scores = opened(winning_blocks(asked, index, key, limit), asked, index, key)
    return (
        _best(scores.withColumn("score", r6(F.col("score"))), key, [F.desc("score"), F.asc("doc")], limit)
        .select(key, F.col("rank").cast("bigint").alias("rank"), "doc", "score")
    )
