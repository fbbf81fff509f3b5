"""Parts of a scored record that are asked for by name: chunk scores, heat map, triangular
diagnostics, given features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.functions.text import r6
from plumbline.operators import grounding as G

HEATMAPS = ("span", "html")


def chunk_scores(responses: DataFrame, units: DataFrame, chunk_tokens: int) -> DataFrame:
    """``resp_id, chunk_ix, char_start, char_end, n_tokens, reverse_context`` per chunk of
    ``chunk_tokens`` tokens of a response."""
    return (
        G.grounded_positions(responses, units)
        .groupBy("resp_id", F.floor(F.col("ix") / chunk_tokens).alias("chunk_ix"))
        .agg(
            F.min("char_start").alias("char_start"),
            F.max("char_end").alias("char_end"),
            F.count(F.lit(1)).alias("n_tokens"),
            r6(F.avg("g_t")).alias("reverse_context"),
        )
    )


def heatmap(responses: DataFrame, units: DataFrame, form: str = "span") -> DataFrame:
    """``resp_id, heatmap``: spans of equal score in order, with ``form`` html also ``heatmap_html``.

    The page is the response with its spans marked; what stands between tokens of
    different score is left as it is, escaped.
    """
    if form not in HEATMAPS:
        raise ValueError(f"heatmap_format is one of {', '.join(HEATMAPS)}")
    spans = G.heatmap_spans(responses, units).select(
        "resp_id", F.struct("char_start", "char_end", "score", "html").alias("s")
    )
    listed = spans.groupBy("resp_id").agg(F.array_sort(F.collect_list("s")).alias("_s"))
    plain = F.transform("_s", lambda s: F.struct(s["char_start"].alias("start"), s["char_end"].alias("end"), s["score"].alias("score")))
    if form == "span":
        return listed.select("resp_id", plain.alias("heatmap"))

    def between(start: Column, end: Column) -> Column:
        piece = F.substring(F.col("response_text"), (start + 1).cast("int"), (end - start).cast("int"))
        for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            piece = F.replace(piece, F.lit(raw), F.lit(safe))
        return piece

    first = F.lit(0).cast("bigint")
    gaps = F.zip_with(
        F.concat(F.array(first), F.transform("_s", lambda s: s["char_end"])),
        F.concat(F.transform("_s", lambda s: s["char_start"]), F.array(F.length("response_text").cast("bigint"))),
        between,
    )
    page = F.array_join(F.zip_with("_gaps", F.concat(F.transform("_s", lambda s: s["html"]), F.array(F.lit(""))), lambda gap, span: F.concat(gap, span)), "")
    return (
        listed.join(responses.select("resp_id", "response_text"), "resp_id")
        .withColumn("_gaps", gaps)
        .select("resp_id", plain.alias("heatmap"), page.alias("heatmap_html"))
    )


def triangular(responses: DataFrame, units: DataFrame, queries: DataFrame) -> DataFrame:
    """``resp_id, reverse_context, reverse_query_context, echo_mean, triangular``.

    Shares of a response's tokens in its units, of its query's tokens in its units, of its
    tokens in its query; and their geometric mean. Without a query the last three are null.
    """
    asked = queries.filter(F.col("query_text").isNotNull()).select("resp_id", "query_text")
    echoed = T.exploded(asked, ["resp_id"], T.distinct_tokens(F.col("query_text")), "term").withColumn("_e", F.lit(1))
    has_query = asked.select("resp_id", F.lit(True).alias("_asked")).distinct()
    shares = (
        G.grounded_terms(responses, units)
        .join(echoed, ["resp_id", "term"], "left")
        .groupBy("resp_id")
        .agg(
            r6(F.sum(F.col("n") * F.col("g")) / F.sum("n")).alias("reverse_context"),
            r6(F.sum(F.col("n") * F.coalesce("_e", F.lit(0))) / F.sum("n")).alias("_echo"),
        )
    )
    found = G.query_context(queries, units).withColumnRenamed("query_context", "reverse_query_context")
    product = F.col("reverse_context") * F.col("reverse_query_context") * F.col("echo_mean")
    return (
        shares.join(has_query, "resp_id", "left")
        .join(found, "resp_id", "left")
        .withColumn("echo_mean", F.when(F.col("_asked"), F.col("_echo")))
        .select("resp_id", "reverse_context", "reverse_query_context", "echo_mean", r6(F.pow(product, F.lit(1.0 / 3.0))).alias("triangular"))
    )


def with_features(scored: DataFrame, given: DataFrame, name: str, lanes: tuple[str, ...] = ()) -> DataFrame:
    """``scored`` with the map ``name``: its lanes that are not null and what ``given(resp_id, name)``
    holds, which wins. A null map counts as empty."""
    own = F.map_filter(
        F.map_from_arrays(F.array(*map(F.lit, lanes)), F.array(*(F.col(c).cast("double") for c in lanes))), lambda _, v: v.isNotNull()
    ) if lanes else F.create_map().cast("map<string,double>")
    extra = F.coalesce(F.col("_given"), F.create_map().cast("map<string,double>"))
    kept = F.map_filter(own, lambda k, _: ~F.map_contains_key(extra, k))
    renamed = given.select("resp_id", F.col(name).cast("map<string,double>").alias("_given"))
    return scored.join(renamed, "resp_id", "left").withColumn(name, F.map_concat(kept, extra)).drop("_given")
