"""Logged responses of the scoring call as typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import rules as R
from plumbline.functions import text as T
from plumbline.sources.envelopes import normalize_envelopes

# Field names and types of a response record.
SCORES = """
    primary_name string, primary_score double, groundedness_v1 double, groundedness_v2 double,
    consensus_hardened double, reverse_context double, reverse_context_calibrated double,
    reverse_query_context double, triangular double, echo_mean double, grounded_coverage double,
    null_bank_size bigint, nli_aggregate double, nli_claim_count bigint, nli_skipped_count bigint,
    nli_contradiction_prob_max double, nli_cascade_triggered boolean, literal_guarded double,
    literal_match_count bigint, literal_mismatch_count bigint, literal_total_count bigint,
    literal_novelty_min double, literal_novelty_missing_count bigint, semantic_entropy_aggregate double,
    semantic_entropy_raw double, semantic_entropy_sample_count bigint, structured_source double,
    structured_source_guarded double, structured_source_detected boolean, coverage_score_u double,
    semantic_entropy double, context_coverage_ratio double, context_coverage_threshold double,
    context_attribution_ratio double, context_attribution_used_count bigint, support_units_used bigint,
    support_units_total bigint, support_units_unused bigint, context_unused_ratio double,
    context_uncertain_ratio double, context_usage_ratio double, dead_weight_ratio double,
    dead_weight_file_count bigint, risk_band string
"""
EVIDENCE = """
    index bigint, support_id string, text string, coverage_score double, usage_state string,
    context_trust_state string, context_trust_score double, context_trust_labels array<string>,
    usage_confidence double
"""
UNSUPPORTED = """
    token_index bigint, token string, heatmap_score double, nli_score double,
    reverse_context_calibrated double, char_start bigint, char_end bigint
"""
DECISION = f"""
    action string, score double, score_channel string, class_key string, band string,
    policy_version string, policy_sha256 string, head_id string, head_version string,
    head_registry_sha256 string, head_enabled boolean, head_score double,
    head_features_used array<string>, head_reason_codes array<string>, reason_codes array<string>,
    evidence array<struct<{EVIDENCE}>>, unsupported_spans array<struct<{UNSUPPORTED}>>,
    allow_disabled boolean, block_disabled boolean, allow_threshold double, block_threshold double,
    rollback_safe boolean
"""
TOKEN = "token string, char_start bigint, char_end bigint, g_t double, e_t double, j_star bigint"
VERDICT = "claim string, label string, score double, premise_index bigint"
CLAIM = """
    index bigint, text string, char_start bigint, char_end bigint, entailment double, neutral double,
    contradiction double, score double, band string, skipped boolean, skip_reason string,
    premise_count bigint, support_ids array<string>, support_unit_indices array<bigint>
"""
ROUTE = "corpus_type string, confidence double, source string, language string, scoring_mode_applied string"
FIELDS = {
    "risk_band": "string",
    "risk_reason": "string",
    "scores": f"struct<{SCORES}>",
    "response_tokens": f"array<struct<{TOKEN}>>",
    "nli": f"array<struct<{VERDICT}>>",
    "nli_diagnostics": f"struct<aggregate_score double, aggregate double, claims array<struct<{CLAIM}>>, claims_total bigint, claims_scored bigint>",
    "runtime_decision": f"struct<{DECISION}>",
    "corpus_route": f"struct<{ROUTE}>",
    "warnings": "array<string>",
    "reason": "string",
    "profile": "string",
    "scoring_mode": "string",
    "attribution_mode": "string",
    "session_id": "string",
    "band": "string",
    "score": "double",
    "groundedness_v2": "double",
    "nli_aggregate": "double",
}


def typed_responses(logs: DataFrame, body: str, header_id: str | None = None) -> DataFrame:
    """Columns of ``logs`` but ``body``, then ``request_id, ok, error``, one typed column per
    field, and the whole payload in ``raw``.

    Job wrappers are opened as in ``normalize_envelopes``; a ``request_id`` inside the
    payload counts when no header or wrapper names one. A missing or ill-typed field is
    null, unknown ones stay in ``raw``. ``risk_band`` is filled from the scores, the flat
    band or the decision, in this order; a given one outside the five bands makes the row
    not ok with error ``schema_error``.
    """
    kept = [c for c in logs.columns if c not in (body, header_id)]
    record = ", ".join(f"{name}: {' '.join(kind.split())}" for name, kind in FIELDS.items())
    payload = F.col("payload")
    # one cast of the whole record, so that the payload is walked once
    opened = normalize_envelopes(logs, body, header_id).withColumn(
        "_record", F.try_variant_get(payload, "$", f"struct<{record}>")
    )
    cast = opened.select(
        *kept,
        F.coalesce("request_id", F.try_variant_get(payload, "$.request_id", "string")).alias("request_id"),
        "ok",
        "error",
        *[F.col(f"_record.{name}").alias(name) for name in FIELDS],
        payload.alias("raw"),
    )
    nli = F.col("nli_diagnostics")
    aggregate = F.coalesce(nli["aggregate_score"], nli["aggregate"])
    band = R.resolve_band_strict(
        F.col("risk_band"), F.col("scores.risk_band"), F.col("band"), F.col("runtime_decision.band")
    )
    bad = F.coalesce(band == "schema_error", F.lit(False))
    return cast.withColumns(
        {
            "nli_diagnostics": F.when(
                nli.isNotNull(), nli.withField("aggregate_score", aggregate).dropFields("aggregate")
            ),
            "risk_band": F.when(~bad, band),
            "ok": F.col("ok") & ~bad,
            "error": F.when(bad, "schema_error").otherwise(F.col("error")),
        }
    )


def trace_records(responses: DataFrame) -> DataFrame:
    """``responses`` (see :func:`typed_responses`) with ``metadata``, the record kept next to an answer.

    JSON of ten fields, nulls left out at every level: the resolved band, the headline score,
    three scores by name, ``request_id``, the decision, all scores, the diagnostics of context
    trust and the payload itself.
    """
    scores, decision = F.col("scores"), F.col("runtime_decision")
    direct = [F.try_variant_get("raw", f"$.{name}", "string") for name in ("trace_score", "groundedness", "score")]
    nested = [scores[name] for name in ("groundedness_v2", "groundedness_v1", "primary_score")]
    fields = {
        "risk_band": R.resolve_band(F.col("risk_band"), scores["risk_band"], F.col("band"), decision["band"]),
        "trace_score": R.resolve_score(*direct, *nested),
        **{name: scores[name] for name in ("groundedness_v2", "coverage_score_u", "context_coverage_ratio")},
        "request_id": F.col("request_id"),
        "runtime_decision": decision,
        "scores": scores,
        "context_trust_diagnostics": F.try_variant_get("raw", "$.context_trust_diagnostics", "variant"),
        "raw": F.col("raw"),
    }
    return responses.withColumn("metadata", R.trace_metadata(fields))


def unsupported_tokens(responses: DataFrame, key: str) -> DataFrame:
    """``key, token_index, token, heatmap_score, char_start, char_end``: the spans a decision flagged."""
    return T.exploded(responses, [key], F.col("runtime_decision.unsupported_spans"), "_span").select(
        key, *[F.col(f"_span.{c}").alias(c) for c in ("token_index", "token", "heatmap_score", "char_start", "char_end")]
    )


def cited_evidence(responses: DataFrame, key: str) -> DataFrame:
    """``key`` and the columns of each evidence unit a decision cites."""
    return T.exploded(responses, [key], F.col("runtime_decision.evidence"), "_unit").select(key, "_unit.*")


def is_backfilled() -> Column:
    """Whether the response itself named no band."""
    return F.try_variant_get("raw", "$.risk_band", "string").isNull() & F.col("risk_band").isNotNull()
