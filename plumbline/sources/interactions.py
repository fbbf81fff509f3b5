"""From message lists and documents to interactions and their support units."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import scan
from plumbline.functions import text as T


def pair_turns(turns: DataFrame) -> DataFrame:
    """One row per assistant turn with the last user message before it.

    ``query_turn`` names that message. The context of a response is every
    non-empty system message before it, in order; as those lists only ever grow
    along a conversation, a response keeps the *length* of its list
    (``n_context``, null when there is none) and the chunks stay in
    :func:`context_chunks` once each.
    """
    is_user = F.col("role") == "user"
    is_context = (F.col("role") == "system") & (F.col("text") != "")
    thin = turns.select(
        "conv_id", "turn", "role", is_user.alias("_user"), is_context.alias("_context")
    )
    scanned = scan.prefix(
        thin,
        ["conv_id"],
        F.col("turn"),
        {
            "query_turn": ("max", F.when(F.col("_user"), F.col("turn"))),
            "_chunks": ("sum", F.col("_context").cast("bigint")),
        },
    ).filter(F.col("role") == "assistant")
    texts = turns.select("conv_id", "turn", "text")
    return (
        scanned.select(
            "conv_id",
            "turn",
            "query_turn",
            F.when(F.col("_chunks") > 0, F.col("_chunks")).alias("n_context"),
        )
        .join(texts.withColumnRenamed("text", "response_text"), ["conv_id", "turn"])
        .join(
            texts.select(
                "conv_id", F.col("turn").alias("query_turn"), F.col("text").alias("query_text")
            ),
            ["conv_id", "query_turn"],
            "left",
        )
    )


def context_chunks(turns: DataFrame) -> DataFrame:
    """System messages in order: chunk ``chunk_ix`` serves responses with a larger ``n_context``."""
    chunks = turns.filter((F.col("role") == "system") & (F.col("text") != ""))
    return scan.prefix(
        chunks.select("conv_id", "turn", "text"),
        ["conv_id"],
        F.col("turn"),
        {"chunk_ix": ("count", F.lit(1))},
    )


def exchange_units(turns: DataFrame) -> DataFrame:
    """Each turn as evidence for the next assistant turn of its conversation.

    A response is judged against what was said since, and including, the answer
    before it, other than its own query. Every turn serves one response, so the
    table is as long as the input, whatever the length of a conversation.
    """
    backwards = -F.col("turn")
    thin = turns.select("conv_id", "turn", "role")
    ahead = scan.prefix(
        thin,
        ["conv_id"],
        backwards,
        {
            "_next_assistant": ("max", F.when(F.col("role") == "assistant", backwards)),
            "_next_user": ("max", F.when(F.col("role") == "user", backwards)),
        },
    ).select(
        "conv_id",
        "turn",
        (-F.col("_next_assistant")).alias("resp_turn"),
        (
            (F.col("role") == "user")
            & (
                F.col("_next_user").isNull()
                | (F.col("_next_user") < F.col("_next_assistant"))
            )
        ).alias("is_query"),
    )
    return (
        ahead.filter(F.col("resp_turn").isNotNull() & ~F.col("is_query"))
        .join(turns.select("conv_id", "turn", "text"), ["conv_id", "turn"])
        .select(
            "conv_id",
            "resp_turn",
            F.col("turn").alias("unit_ix"),
            F.concat(F.lit("turn_"), F.col("turn")).alias("source_id"),
            "text",
        )
    )


def split_documents(docs: DataFrame, units_per_source: int = 5) -> DataFrame:
    """Each document as one request: the first 80 % of its segments are the
    support units, the rest is the response. Narrow: no shuffle."""
    kept = T.let(
        F.filter(T.pieces(F.col("text"), T.SEGMENT_END), T.has_token),
        lambda p: T.let(
            F.struct(p.alias("p"), F.floor(F.size(p) * 4 / 5).cast("int").alias("n")),
            lambda s: F.struct(
                F.transform(F.slice(s["p"], 1, s["n"]), T.trimmed).alias("units"),
                T.trimmed(
                    F.array_join(F.slice(s["p"], s["n"] + 1, F.size(s["p"])), "")
                ).alias("response"),
            ),
        ),
    )
    return docs.select(F.col("doc_id").alias("resp_id"), kept.alias("_r")).select(
        "resp_id",
        F.col("_r.response").alias("response_text"),
        F.transform(
            "_r.units",
            lambda u, i: F.struct(
                u.alias("text"),
                F.concat(F.lit("part_"), F.floor(i / units_per_source)).alias("source_id"),
            ),
        ).alias("support_units"),
    )


def document_units(requests: DataFrame) -> DataFrame:
    """``resp_id, unit_ix, source_id, text`` of :func:`split_documents`."""
    return T.positions(requests, ["resp_id"], F.col("support_units"), "unit_ix", "u").select(
        "resp_id", "unit_ix", "u.source_id", "u.text"
    )
