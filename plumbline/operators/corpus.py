"""Corpus-wide operators: open-domain evidence, late interaction, answer entropy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.functions.text import r6
from plumbline.operators import grounding as G
from plumbline.operators import postings
from plumbline.session import materialise


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two numeric arrays; 0 when one has no length."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(
            F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")),
            F.lit(0.0),
            lambda acc, v: acc + v,
        )

    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b))), F.lit(0.0))


def max_sim(query_vectors: Column, unit_vectors: Column) -> Column:
    """Late interaction: per query vector the best cosine over the unit's vectors,
    then the mean. Both sides are one text's vectors, held in one row."""
    best = F.transform(
        query_vectors,
        lambda q: F.array_max(F.transform(unit_vectors, lambda u: cosine(q, u))),
    )
    return F.aggregate(best, F.lit(0.0), lambda acc, v: acc + v) / F.size(query_vectors)


def vector_sets(vectors: DataFrame, size: int = 8) -> DataFrame:
    """``set_id, vectors``: consecutive vectors as the multi-vector form of one text."""
    return (
        vectors.groupBy(F.floor(F.col("vec_id") / size).alias("set_id"))
        .agg(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))).alias("_v"))
        .select("set_id", F.transform("_v", lambda v: v["embedding"]).alias("vectors"))
    )


def maxsim(responses: DataFrame, units: DataFrame) -> DataFrame:
    """``resp_id, maxsim`` for ``responses(resp_id, vectors)`` and
    ``units(resp_id, vectors)``: an equi-join, scored row by row."""
    return (
        responses.withColumnRenamed("vectors", "_q")
        .join(units.withColumnRenamed("vectors", "_u"), "resp_id")
        .select("resp_id", r6(max_sim(F.col("_q"), F.col("_u"))).alias("maxsim"))
    )


def semantic_entropy(answers: DataFrame, query: str, cluster: str) -> DataFrame:
    """Entropy over the answer clusters of each query: raw, and divided by ``ln(n)``.

    Only cluster counts are combined, so a query or cluster of any size is fine.
    """
    counts = answers.groupBy(query, cluster).agg(F.count(F.lit(1)).alias("_c"))
    c = F.col("_c").cast("double")
    summed = counts.groupBy(query).agg(
        F.sum("_c").alias("n_samples"),
        F.count(F.lit(1)).alias("n_clusters"),
        F.sum(c * F.log(c)).alias("_clogc"),
    )
    n = F.col("n_samples").cast("double")
    raw = F.log(n) - F.col("_clogc") / n
    return summed.select(
        query,
        "n_samples",
        "n_clusters",
        r6(F.abs(raw)).alias("semantic_entropy_raw"),
        r6(F.when(F.col("n_samples") < 2, 0.0).otherwise(F.abs(raw) / F.log(n))).alias("semantic_entropy"),
    )


def answer_key(text: Column) -> Column:
    """Answers with the same set of terms fall in one cluster."""
    return F.sha2(F.array_join(F.array_sort(T.distinct_tokens(text)), " "), 256)


def open_domain_topk(
    responses: DataFrame, corpus: DataFrame, limit: int = 3, block_docs: int = postings.BLOCK_DOCS
) -> DataFrame:
    """The ``limit`` corpus documents with the largest idf overlap, for every response.

    Exact, over posting blocks (:mod:`postings`): only blocks of documents that can
    still win are opened. The corpus is cut into terms once, and the index is written
    to the shared folder.
    """
    index = materialise(postings.block_index(corpus, block_docs), "postings")
    total = corpus.agg(F.count(F.lit(1))).scalar()
    asked = materialise(
        T.exploded(responses, ["resp_id"], T.distinct_tokens(F.col("response_text")), "term")
        .join(postings.term_statistics(index), "term")
        .select("resp_id", "term", G.idf(F.col("df"), total).alias("weight")),
        "asked",
    )
    return postings.top_documents(asked, index, "resp_id", limit).withColumnRenamed("doc", "doc_id")
