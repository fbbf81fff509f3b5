"""The three products in one call each: groundedness, redaction, compression.

Every argument that names a table is a DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import rules as R
from plumbline.functions import text as T
from plumbline.operators import claims, compress, corpus, decide, heads, literals, privacy, record
from plumbline.operators import grounding as G

# Named parameter bundles. "quality" checks more evidence and asks for more of it.
PROFILES = {
    "standard": {"evidence_limit": 3, "coverage_threshold": 0.3},
    "quality": {"evidence_limit": 5, "coverage_threshold": 0.4},
}

# lanes that a learned head may use beside the features it is given
HEAD_LANES = ("groundedness_v1", "groundedness_v2", "literal_match_ratio", "nli_aggregate")
COMPACT = ("resp_id", "risk_band", "primary_score", "action", "risk_reason", "scoring_mode", "head_score")


def score_groundedness(
    responses: DataFrame,
    units: DataFrame | None = None,
    *,
    raw_context: DataFrame | None = None,
    chunk_tokens: int = 64,
    chunk_ids: DataFrame | None = None,
    queries: DataFrame | None = None,
    calibration: DataFrame | None = None,
    class_key: str = decide.ANY,
    language: str = decide.ANY,
    scorer: Callable[[Column, Column], Column] | None = None,
    attribution_mode: str = "closed_book",
    corpus_table: DataFrame | None = None,
    primary_metric: str = "groundedness_v2",
    coverage_threshold: float | None = None,
    evidence_limit: int | None = None,
    context_trust_enabled: bool = True,
    profile: str = "standard",
    amber_at: float = 0.2,
    green_at: float = 0.35,
    locale: str | None = None,
    scoring_mode: str | None = None,
    response_chunk_tokens: int | None = None,
    include_triangular_diagnostics: bool = False,
    heatmap_format: str | None = None,
    runtime_head_features: DataFrame | None = None,
    head: heads.Head | None = None,
    trajectory_features: DataFrame | None = None,
    auto_decide: bool = True,
    response_format: str = "canonical",
) -> DataFrame:
    """Scores, band, decision and evidence of each response.

    ``responses(resp_id, response_text)``; ``units(resp_id, unit_ix, source_id, text)``,
    or ``raw_context(resp_id, source_id, text)``, cut into units of ``chunk_tokens``
    tokens. ``chunk_ids(resp_id, unit_ix)`` names the units to use. ``queries(resp_id,
    query_text)`` adds ``query_context``, the share of a query's tokens that its units
    hold. ``calibration`` is a table of cut-offs (see ``decide.table_band``) in place of
    ``amber_at`` and ``green_at``; class and language come from columns ``class_key`` and
    ``language`` of ``responses`` where it has them, else from the arguments. ``scorer``
    judges claims (see ``claims.verify``).
    In ``open_domain`` mode the evidence is looked up in ``corpus_table(doc_id, text)``
    and ``units`` is ignored. Every response gets a row: one without trusted evidence is
    ``unsupported`` and never allowed, an empty one is red and blocked for
    ``empty_input``.

    About ten branches of the plan start from the responses and the evidence, so both are
    tokenised and written to the shared folder once when this is called.
    """
    if attribution_mode not in ("closed_book", "open_domain"):
        raise ValueError("attribution_mode is closed_book or open_domain")
    if response_format not in ("canonical", "compact"):
        raise ValueError("response_format is canonical or compact")
    if locale is not None:
        if language not in (decide.ANY, locale):
            raise ValueError("pass either language or locale, not both")
        language = locale
    if include_triangular_diagnostics and queries is None:
        raise ValueError("include_triangular_diagnostics needs queries")
    preset = PROFILES[profile]
    limit = evidence_limit or preset["evidence_limit"]
    threshold = coverage_threshold if coverage_threshold is not None else preset["coverage_threshold"]
    if attribution_mode == "open_domain":
        if corpus_table is None:
            raise ValueError("open_domain needs corpus_table")
        units = open_domain_units(responses.filter(~R.is_empty(F.col("response_text"))), corpus_table, limit)
    elif (units is None) == (raw_context is None):
        raise ValueError("give either units or raw_context")
    elif raw_context is not None:
        units = raw_units(raw_context, chunk_tokens)
    if chunk_ids is not None:
        units = units.join(chunk_ids.select("resp_id", "unit_ix").distinct(), ["resp_id", "unit_ix"], "left_semi")
    saved, evidence = G.tokenised(responses, literals.trusted_units(units, context_trust_enabled))
    answered = saved.filter(~R.is_empty(F.col("response_text")))
    blank = saved.filter(R.is_empty(F.col("response_text"))).select(
        "resp_id",
        F.lit("red").alias("risk_band"),
        F.lit("block").alias("action"),
        F.array(F.lit("empty_input")).alias("reason_codes"),
        F.lit("empty_input").alias("risk_reason"),
    )
    scores = claims.fuse(claims.lanes(answered, evidence, scorer), primary_metric)
    coverage = G.coverage_stats(answered, evidence, threshold)
    best = (
        G.top_evidence(answered, evidence, limit)
        .groupBy("resp_id")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "unit_ix", "coverage"))).alias("evidence"))
    )
    given = {"class_key": class_key, "language": language}
    scored = (
        answered.select(
            "resp_id", *[F.col(c) if c in answered.columns else F.lit(v).alias(c) for c, v in given.items()]
        )
        .join(scores, "resp_id", "left")
        .join(coverage, "resp_id", "left")
        .withColumn("score", F.col("primary_score"))
        .withColumn("n_units", F.coalesce("n_units", F.lit(0)))
    )
    if queries is not None:
        asked = G.query_context(queries, evidence)
        scored = scored.join(asked, "resp_id", "left")
    if calibration is None:
        fixed = scored.withColumns({"amber_at": F.lit(amber_at), "green_at": F.lit(green_at)})
        band = F.when(F.col("n_units") == 0, "unsupported").otherwise(
            decide.band_of(F.col("score"), amber_at, green_at)
        )
        banded = fixed.withColumn("band", band)
    else:
        banded = decide.table_band(scored, calibration)
    banded = banded.withColumns({"allow_disabled": F.lit(False), "block_disabled": F.lit(False)})
    out = (
        decide.runtime_decision(banded)
        .join(best, "resp_id", "left")
        .withColumnRenamed("band", "risk_band")
        .drop("allow_disabled", "block_disabled", "score", "score_channel")
    )
    if response_chunk_tokens is not None:
        chunks = record.chunk_scores(answered, evidence, response_chunk_tokens)
        part = F.struct("chunk_ix", "char_start", "char_end", "n_tokens", "reverse_context")
        listed = chunks.groupBy("resp_id").agg(F.array_sort(F.collect_list(part)).alias("response_chunks"))
        out = out.join(listed, "resp_id", "left")
    if include_triangular_diagnostics:
        three = record.triangular(answered, evidence, queries)
        out = out.join(three.select("resp_id", F.struct(*three.columns[1:]).alias("triangular_diagnostics")), "resp_id", "left")
    if heatmap_format is not None:
        out = out.join(record.heatmap(answered, evidence, heatmap_format), "resp_id", "left")
    if runtime_head_features is not None:
        out = record.with_features(out, runtime_head_features, "runtime_head_features", HEAD_LANES)
        if head is not None:
            named = out.select("resp_id", *(F.col("runtime_head_features")[f].alias(f) for f in head.features))
            scored = heads.apply_head(named, head).select("resp_id", "head_score", "head_features_used")
            out = out.join(scored, "resp_id", "left")
    if trajectory_features is not None:
        out = record.with_features(out, trajectory_features, "trajectory_features")
    out = out.unionByName(blank, allowMissingColumns=True)
    if scoring_mode is not None:
        out = out.withColumn("scoring_mode", F.lit(scoring_mode))
    if not auto_decide:
        out = out.drop("action", "reason_codes", "risk_reason")
    return out if response_format == "canonical" else out.select(*(c for c in COMPACT if c in out.columns))


def raw_units(raw_context: DataFrame, chunk_tokens: int) -> DataFrame:
    """Whole context texts, one row per source of a response, as units numbered per response."""
    in_order = Window.partitionBy("resp_id").orderBy("source_id", "chunk_ix")
    chunks = T.chunk_rows(raw_context, ["resp_id", "source_id"], "text", chunk_tokens)
    return chunks.select(
        "resp_id", (F.row_number().over(in_order) - 1).cast("bigint").alias("unit_ix"), "source_id", "text"
    )


def open_domain_units(responses: DataFrame, corpus_table: DataFrame, limit: int) -> DataFrame:
    """The best corpus documents of each response as its support units."""
    best = corpus.open_domain_topk(responses, corpus_table, limit)
    return best.join(corpus_table.select("doc_id", "text"), "doc_id").select(
        "resp_id",
        (F.col("rank") - 1).alias("unit_ix"),
        F.concat(F.lit("doc-"), F.col("doc_id")).alias("source_id"),
        "text",
    )


def rag(
    responses: DataFrame,
    units: DataFrame | None = None,
    *,
    context_trust_enabled: bool = False,
    scoring_mode: str = "rag",
    **options,
) -> DataFrame:
    """:func:`score_groundedness` for retrieval answers: context trust is off unless asked for,
    and the scoring mode is recorded."""
    return score_groundedness(
        responses, units, context_trust_enabled=context_trust_enabled, scoring_mode=scoring_mode, **options
    )


def annotate_retrieved(queries: DataFrame, units: DataFrame, **options) -> DataFrame:
    """``units`` with ``annotation``: the record of scoring what was retrieved for a query, before an answer exists.

    ``queries(resp_id, query_text)``; ``units(resp_id, unit_ix, source_id, text)`` and, if they
    have one, an ``annotation``, which is kept. The texts of a request's units in order, joined
    by a space, are scored as the response against the units themselves. Units without a
    query, or whose request has no text at all, get nothing. ``options`` go to :func:`rag`.
    """
    asked = queries.filter(F.col("query_text").isNotNull())
    held = units.join(asked.select("resp_id").distinct(), "resp_id", "left_semi").filter(F.col("text").isNotNull())
    in_order = F.array_sort(F.collect_list(F.struct("unit_ix", "text")))
    joined = held.groupBy("resp_id").agg(F.array_join(F.transform(in_order, lambda u: u["text"]), " ").alias("response_text"))
    scored = rag(joined.filter(~R.is_empty(F.col("response_text"))), held.select("resp_id", "unit_ix", "source_id", "text"), queries=asked, **options)
    numbers = [f.name for f in scored.schema.fields if f.dataType.typeName() in ("double", "long", "integer") and f.name != "resp_id"]
    fields = {
        "risk_band": F.col("risk_band"),
        "trace_score": F.col("primary_score"),
        **{c: F.col(c) for c in ("groundedness_v2", "coverage_score_u", "context_coverage_ratio") if c in numbers},
        "runtime_decision": F.struct("action", "reason_codes", F.col("risk_band").alias("band")),
        "scores": F.struct(*numbers),
    }
    fresh = scored.select("resp_id", R.trace_metadata(fields).alias("_fresh"))
    given = F.col("annotation") if "annotation" in units.columns else F.lit(None).cast("string")
    return units.join(fresh, "resp_id", "left").withColumn("annotation", F.coalesce(given, "_fresh")).drop("_fresh")


redact = privacy.redact
compress_text = compress.compress_text
compress_messages = compress.compress_messages
