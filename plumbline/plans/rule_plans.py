"""Record rules, log readers and set operators on data derived from the tables.

The inputs are written once as SQL expressions over a table's columns, so both
engines derive the same rows from the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import rules as R
from plumbline.functions import text as T
from plumbline.operators import grounding as G
from plumbline.plans import sqlparts as S
from plumbline.plans.grounding_plans import requests
from plumbline.sources import envelopes as X
from plumbline.sources import responses as L
from plumbline.sources import tables
from plumbline.sources.interactions import split_documents
from plumbline.sources.tables import read_table

# Response log, one row per event.
RESPONSES = {
    "risk_band": "CASE event_id % 7 WHEN 0 THEN 'LOW' WHEN 1 THEN ' Amber ' WHEN 2 THEN '' WHEN 3 THEN 'red' END",
    "scores_band": "CASE event_id % 5 WHEN 0 THEN 'Green' WHEN 1 THEN 'medium' WHEN 2 THEN '  ' END",
    "band": "CASE event_id % 3 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'purple' END",
    "decision_band": "CASE event_id % 2 WHEN 0 THEN 'unsupported' END",
    "trace_score": "CASE event_id % 6 WHEN 0 THEN CAST(event_id % 100 AS STRING) WHEN 1 THEN 'n/a' WHEN 2 THEN '0.5f' WHEN 3 THEN '1d' END",
    "groundedness": "CASE event_id % 4 WHEN 0 THEN '0.25' WHEN 1 THEN '' END",
    "score": "CASE event_id % 9 WHEN 0 THEN '1e-1' END",
    "groundedness_v2": "CASE event_id % 5 WHEN 0 THEN '0.82' END",
    "groundedness_v1": "CASE event_id % 3 WHEN 0 THEN '0.5' END",
    "primary_score": "CASE event_id % 8 WHEN 0 THEN '0.75' END",
}
# Answers with context and outcome, one row per conversation turn.
ANSWERS = {
    "answer": "CASE WHEN turn % 4 = 3 THEN '' ELSE text END",
    "raw_context": "CASE conv_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE role END",
    "closed_book": "conv_id % 2 = 0",
    "error": "CASE WHEN (conv_id + turn) % 7 = 0 THEN 'timed out' END",
    "band": "CASE (conv_id + turn) % 4 WHEN 0 THEN 'green' WHEN 1 THEN 'amber' WHEN 2 THEN 'red' ELSE 'unknown' END",
    "score": "CAST((conv_id + turn) % 10 AS DOUBLE) / 10",
    "output": "CASE WHEN turn % 3 = 0 THEN role WHEN turn % 3 = 1 THEN '' END",
    "result": "CASE WHEN conv_id % 2 = 0 THEN text END",
    "language": "CASE conv_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'de' END",
    "locale": "CASE turn % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' END",
    "response_text": "CASE WHEN conv_id % 5 = 4 THEN NULL ELSE text END",
}
# Logged bodies of a hosted job, one per event.
BODIES = """CASE event_id % 12
  WHEN 0 THEN '{"id":"job-' || CAST(event_id AS STRING) || '","status":"COMPLETED","output":{"result":{"band":"amber","score":' || CAST(event_id % 10 AS STRING) || '}}}'
  WHEN 1 THEN '{"id":' || CAST(event_id AS STRING) || ',"status":"completed_with_errors","output":{"band":"green"}}'
  WHEN 2 THEN '{"id":"job-' || CAST(event_id AS STRING) || '","status":"FAILED","error":"boom ' || event_type || '"}'
  WHEN 3 THEN '{"status":"COMPLETED","output":{"success":false,"message":"refused"}}'
  WHEN 4 THEN '{"band":"red","score":0.5,"id":"direct"}'
  WHEN 5 THEN '{"success":false}'
  WHEN 6 THEN '{"id":"q","status":"IN_QUEUE","output":null,"error":""}'
  WHEN 7 THEN 'not json'
  WHEN 8 THEN '{"status":null,"output":{"band":"red"}}'
  WHEN 9 THEN '{"status":"COMPLETED","output":null}'
  WHEN 10 THEN '{"success":"false","band":"amber"}'
  ELSE '{"status":"TIMED_OUT","output":"late"}' END"""
ROLLUPS = """CASE event_id % 5
  WHEN 0 THEN '{"success":true,"action":"rollup","version":"1","rollup":{"turns":' || CAST(event_id AS STRING) || ',"noise_pct":0.25}}'
  WHEN 1 THEN '{"turns":' || CAST(event_id AS STRING) || ',"session_id":"s","id":"x"}'
  WHEN 2 THEN '{"success":true,"version":"2","extra":' || CAST(event_id AS STRING) || '}'
  WHEN 3 THEN '{"other":1}'
  ELSE '{"rollup":null,"action":"rollup"}' END"""
STATUSES = "CAST(CASE event_id % 10 WHEN 0 THEN 401 WHEN 1 THEN 402 WHEN 2 THEN 422 WHEN 3 THEN 429 WHEN 4 THEN 500 WHEN 5 THEN 503 WHEN 6 THEN 404 WHEN 7 THEN 403 ELSE 422 END AS INT)"
ERRORS = """CASE event_id % 9
  WHEN 0 THEN '{"detail":{"code":"license_missing","message":"no licence ' || CAST(event_id AS STRING) || '","hint":"buy"}}'
  WHEN 1 THEN '{"success":false,"error_code":"E' || CAST(event_id % 3 AS STRING) || '","error":"bad ' || event_type || '"}'
  WHEN 2 THEN '{"detail":"plain text"}'
  WHEN 3 THEN '{"detail":[{"loc":["body","response_text"],"msg":"Field required"}]}'
  WHEN 4 THEN '{"code":"only_code"}'
  WHEN 5 THEN '{"detail":[{"msg":"no place"}]}'
  WHEN 6 THEN '{"detail":["bad"]}'
  WHEN 7 THEN '{"detail":[]}'
  ELSE '[]' END"""


# Logged responses in the nested, the flat and the wrapped form, one per event.
SCORED = """CASE event_id % 8
  WHEN 0 THEN '{"risk_band":"red","scores":{"primary_score":0.' || CAST(event_id % 10 AS STRING) || ',"support_units_used":4,"risk_band":"green"},"extra":' || CAST(event_id AS STRING) || ',
    "runtime_decision":{"action":"block","band":"red","reason_codes":["a","b:' || event_type || '"],"rollback_safe":true,
    "evidence":[{"index":0,"support_id":"s0","coverage_score":0.3},{"index":1,"support_id":"s' || CAST(event_id AS STRING) || '"}],
    "unsupported_spans":[{"token_index":12,"token":"' || event_type || '","heatmap_score":0.1}]}}'
  WHEN 1 THEN '{"id":"j' || CAST(event_id AS STRING) || '","status":"COMPLETED","output":{"band":"amber","groundedness_v2":0.62}}'
  WHEN 2 THEN '{"scores":{"risk_band":"LOW","primary_score":"no number"},"band":"red","request_id":"inner"}'
  WHEN 3 THEN '{"scores":{"risk_band":"purple"},"runtime_decision":{"band":"High","action":"warn"},"nli_diagnostics":{"aggregate":0.5}}'
  WHEN 4 THEN '{"risk_band":"purple","groundedness_v2":1}'
  WHEN 5 THEN '{"response_tokens":[{"token":"x","char_start":0,"char_end":1,"g_t":0.25}],"nli_diagnostics":{"aggregate_score":0.75}}'
  WHEN 6 THEN '{"status":"FAILED","error":"boom"}'
  ELSE 'not json' END"""


TRACED = """CASE event_id % 4
  WHEN 0 THEN '{"risk_band":"red","trace_score":0.' || CAST(event_id % 10 AS STRING) || ',"request_id":"r' || CAST(event_id AS STRING) || '",
    "scores":{"groundedness_v2":0.5,"coverage_score_u":0.25,"context_coverage_ratio":0.75,"echo_mean":null},
    "runtime_decision":{"action":"block","band":null,"reason_codes":["' || event_type || '"]},
    "context_trust_diagnostics":{"state":"' || event_type || '","n":' || CAST(event_id AS STRING) || '}}'
  WHEN 1 THEN '{"trace_score":"no number","scores":{"risk_band":" HIGH ","groundedness_v1":0.125}}'
  WHEN 2 THEN 'not json'
  ELSE '{"band":"medium","groundedness":"0.875","score":0.25}' END"""


def _sql_columns(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in columns.items())


def _responses(spark, sf_dir) -> DataFrame:
    events = read_table(spark, sf_dir, "events", "event_id")
    return events.selectExpr("event_id", *[f"{e} AS {n}" for n, e in RESPONSES.items()])


def _answers(spark, sf_dir) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    return turns.selectExpr("conv_id", "turn", "role", "text", *[f"{e} AS {n}" for n, e in ANSWERS.items()])


def _events(spark, sf_dir, **columns) -> DataFrame:
    events = read_table(spark, sf_dir, "events", "event_id", "event_type")
    return events.selectExpr("event_id", *[f"{e} AS {n}" for n, e in columns.items()])


def _bands(rule):
    def run(spark, sf_dir):
        band = rule(*[F.col(c) for c in ("risk_band", "scores_band", "band", "decision_band")])
        return _responses(spark, sf_dir).select("event_id", band.alias("resolved"))

    return run


_SCORES = ("trace_score", "groundedness", "score", "groundedness_v2", "groundedness_v1", "primary_score")


def _score(spark, sf_dir):
    return _responses(spark, sf_dir).select(
        "event_id", R.resolve_score(*[F.col(c) for c in _SCORES]).alias("resolved")
    )


def _metadata(spark, sf_dir):
    c = F.col
    return _responses(spark, sf_dir).select(
        "event_id",
        R.trace_metadata(
            {
                "risk_band": R.resolve_band(c("risk_band"), c("scores_band"), c("band"), c("decision_band")),
                "groundedness_v2": c("groundedness_v2"),
                "request_id": F.when(c("event_id") % 2 == 0, c("event_id")),
            }
        ).alias("metadata"),
    )


def _route(spark, sf_dir):
    c = F.col
    band = R.resolve_band(c("risk_band"), c("scores_band"), c("band"), c("decision_band"))
    return _responses(spark, sf_dir).select("event_id", R.route(band).alias("route"))


def _rejected(spark, sf_dir):
    return (
        _answers(spark, sf_dir)
        .filter(R.is_rejected(F.col("band"), ("red", "unknown")))
        .select("conv_id", "turn", "band")
    )


def _accepted(spark, sf_dir):
    return (
        _answers(spark, sf_dir)
        .filter(~R.is_rejected(F.col("band"), ("red", "unknown")))
        .select("conv_id", "turn", "band")
    )


def _block(spark, sf_dir):
    return _answers(spark, sf_dir).select(
        "conv_id", "turn", R.block_on_red(F.col("text"), F.col("band")).alias("reply")
    )


def _skip(spark, sf_dir):
    c = F.col
    return (
        _answers(spark, sf_dir)
        .filter(R.should_score(c("answer"), c("raw_context"), c("closed_book")))
        .select("conv_id", "turn", "answer", "raw_context")
    )


def _closed(spark, sf_dir):
    c = F.col
    band, score = R.fail_closed(
        c("answer"), c("raw_context"), c("error").isNotNull(), c("band"), c("score")
    )
    return _answers(spark, sf_dir).select(
        "conv_id", "turn", band.alias("trace_band"), score.alias("trace_score")
    )


def _empty(spark, sf_dir):
    c = F.col
    band, score, reason = R.empty_input(
        c("answer"), c("raw_context"), c("error"), c("band"), c("score")
    )
    return _answers(spark, sf_dir).select(
        "conv_id", "turn", band.alias("band"), score.alias("groundedness"), reason.alias("reason")
    )


def _pick(spark, sf_dir):
    c = F.col
    return _answers(spark, sf_dir).select(
        "conv_id",
        "turn",
        R.pick_response(c("output"), c("answer"), c("text"), c("result")).alias("chain_response"),
        R.pick_filled(c("answer"), c("result")).alias("graph_response"),
    )


def _validate(spark, sf_dir):
    c = F.col
    checked = _answers(spark, sf_dir).select(
        "conv_id",
        "turn",
        R.canonical_language(c("language"), c("locale")).alias("language"),
        R.reject_reason(c("response_text"), c("language"), c("locale")).alias("reason"),
        R.lane_warning(F.nullif("raw_context", F.lit("")), c("result")).alias("warning"),
    )
    valid = checked.filter(c("reason").isNull()).drop("reason")
    rejected = checked.filter(c("reason").isNotNull()).drop("language", "warning")
    return valid.unionByName(rejected, allowMissingColumns=True)


def _coerce(spark, sf_dir):
    def item(page: str, content: str, text: str):
        return F.struct(
            F.expr(page).alias("page_content"),
            F.expr(content).alias("content"),
            F.expr(text).alias("text"),
        )

    context = F.array(
        item("CASE WHEN turn % 2 = 0 THEN text ELSE '' END", "CASE WHEN turn % 3 = 0 THEN role END", "text"),
        item("CAST(NULL AS STRING)", "''", "CAST(NULL AS STRING)"),
        item("CAST(NULL AS STRING)", "CASE WHEN conv_id % 2 = 0 THEN role ELSE '' END", "''"),
    )
    dropped = F.when(F.expr("conv_id % 7 = 3"), F.slice(context, 2, 1)).otherwise(context)
    turns = read_table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", R.coerce_context(dropped).alias("c")).select(
        "conv_id",
        "turn",
        F.when(F.col("c").isNotNull(), F.size("c").cast("bigint")).alias("n_chunks"),
        R.join_context(F.col("c")).alias("raw_context"),
    )


def _content(spark, sf_dir):
    part = F.struct(F.lit("text").alias("type"), F.col("text"))
    image = F.struct(F.lit("image").alias("type"), F.lit("x.png").alias("text"))
    role = F.struct(F.lit("text").alias("type"), F.col("role").alias("text"))
    quoted = F.regexp_extract(F.to_json(F.struct(F.col("text").alias("t"))), r"(?s)^\{\"t\":(.*)\}$", 1)
    body = (
        F.when(F.expr("turn % 3 = 0"), quoted)
        .when(F.expr("turn % 3 = 1"), F.to_json(F.array(part, image, role)))
        .when(F.expr("conv_id % 2 = 0"), F.concat(F.lit("["), quoted, F.lit(',"tail",7]')))
        .when(F.expr("conv_id % 4 = 1"), F.col("text"))  # plain, not JSON
    )
    turns = read_table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", R.flatten_content(body).alias("content"))


def _scan(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations")
    body = F.to_json(
        F.struct(
            F.col("text").alias("response_text"),
            F.when(F.expr("turn % 2 = 1"), F.col("role")).alias("raw_context"),
            F.when(F.expr("conv_id % 3 = 0"), F.lit("en")).alias("language"),
            F.col("turn").alias("evidence_limit"),
            F.array(
                F.struct(F.col("role").alias("speaker"), F.col("text")),
                F.struct(F.lit("b").alias("speaker"), F.lit("x").alias("text")),
            ).alias("support_units"),
            F.concat(F.lit("v"), F.col("conv_id")).alias("unlisted"),
        )
    )
    typed = tables.parse_interactions(turns.select("conv_id", "turn", body.alias("body")), "body")
    return typed.select(
        "conv_id",
        "turn",
        "response_text",
        "raw_context",
        "language",
        "evidence_limit",
        F.size("support_units").cast("bigint").alias("n_units"),
        F.col("support_units")[0]["text"].alias("first_unit"),
        F.try_variant_get("raw", "$.unlisted", "string").alias("unlisted"),
    )


def _explode(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    full = F.transform(
        "support_units",
        lambda u, i: F.struct(
            u["text"].alias("text"),
            u["source_id"].alias("source_id"),
            F.when(i % 2 == 0, F.lit("user")).alias("speaker"),
            F.when(i % 3 == 0, F.lit("2024-01-01 00:00:00")).otherwise(F.lit("soon")).alias("timestamp"),
            F.create_map(F.lit("ix"), i.cast("string")).alias("metadata"),
        ),
    )
    rows = tables.explode_units(split_documents(docs), "resp_id", full)
    return rows.select(
        "resp_id",
        "unit_ix",
        "text",
        "source_id",
        "speaker",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("said_at"),
        F.col("metadata")["ix"].alias("meta_ix"),
    )


def _chunk_requests(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations", "conv_id", "turn")
    return turns.selectExpr(
        "conv_id", "turn",
        "explode(array(concat('doc-', conv_id * 7 + turn), concat('doc-', conv_id * 31))) AS chunk_id",
    )


def _chunk_table(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select(F.concat(F.lit("doc-"), F.col("doc_id")).alias("chunk_id"), "text")


def _by_chunk(spark, sf_dir):
    return _chunk_requests(spark, sf_dir).join(_chunk_table(spark, sf_dir), "chunk_id")


def _missing_chunks(spark, sf_dir):
    return _chunk_requests(spark, sf_dir).join(
        _chunk_table(spark, sf_dir).select("chunk_id"), "chunk_id", "left_anti"
    )


def _union_lanes(spark, sf_dir):
    responses, units = requests(spark, sf_dir)
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    chunks = T.chunk_rows(docs, ["doc_id"], "text", 64).select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("resp_id"),
        F.col("chunk_ix").alias("unit_ix"),
        "text",
        F.lit("raw_context").alias("lane"),
    )
    support = units.select(
        F.concat(F.lit("d"), F.col("resp_id")).alias("resp_id"),
        "unit_ix",
        "source_id",
        "text",
        F.lit("support_units").alias("lane"),
    )
    by_id = _by_chunk(spark, sf_dir).select(
        F.concat_ws(":", "conv_id", "turn").alias("resp_id"),
        F.col("chunk_id").alias("source_id"),
        "text",
        F.lit("chunk_ids").alias("lane"),
    )
    return support.unionByName(chunks, allowMissingColumns=True).unionByName(
        by_id, allowMissingColumns=True
    )


def _envelopes(spark, sf_dir):
    logs = _events(spark, sf_dir, body=BODIES, header="CASE WHEN event_id % 16 = 0 THEN 'hdr' END")
    return X.normalize_envelopes(logs, "body", "header").select(
        "event_id",
        "request_id",
        "ok",
        "error",
        F.try_variant_get("payload", "$.band", "string").alias("band"),
        F.try_variant_get("payload", "$.score", "double").alias("score"),
    )


def _rollups(spark, sf_dir):
    rows = X.normalize_rollup(_events(spark, sf_dir, body=ROLLUPS), "body")
    return rows.select(
        "event_id",
        F.try_element_at("metrics", F.lit("turns")).cast("bigint").alias("turns"),
        F.try_element_at("metrics", F.lit("noise_pct")).cast("double").alias("noise_pct"),
        F.array_join(F.array_sort(F.map_keys("metrics")), ",").alias("keys"),
    )


def _classified(spark, sf_dir):
    return X.classify_errors(
        _events(spark, sf_dir, status=STATUSES, body=ERRORS), "status", "body"
    ).drop("body", "status", "docs_url", "extra")


# the same bodies with further keys, and errors in a wrapper of their own
FURTHER = """CASE event_id % 4
  WHEN 0 THEN '{"detail":{"code":"E0","message":"m","docs_url":"https://d/' || event_type || '","trace":{"id":' || event_id || '},"note":"n"}}'
  WHEN 1 THEN '{"success":false,"error_code":"E1","error":"slow down","status_code":429,"docs_url":7,"retry":' || event_id || '}'
  WHEN 2 THEN '{"detail":"gone","docs_url":"https://x"}'
  ELSE '{"docs_url":"https://x","note":"n"}' END"""


def _error_envelopes(spark, sf_dir):
    rows = X.classify_errors(_events(spark, sf_dir, status="500", body=FURTHER), "status", "body")
    shown = F.transform(F.array_sort(F.map_entries("extra")), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))
    return rows.select("event_id", "code", "message", "docs_url", F.array_join(shown, ";").alias("extra"))


def _quoted(column: str) -> str:
    """A string column as a JSON string."""
    return f"substring(to_json(array({column})), 2, length(to_json(array({column}))) - 2)"


SHAPES = f"""CASE turn % 7
  WHEN 0 THEN {_quoted('text')}
  WHEN 1 THEN '""'
  WHEN 2 THEN concat('{{"page_content":"","content":', {_quoted('role')}, ',"text":', {_quoted('text')}, '}}')
  WHEN 3 THEN concat('[', {_quoted('text')}, ',"",{{"page_content":', {_quoted('role')}, '}},{{"content":7,"text":"t"}},5,null,["x"]]')
  WHEN 4 THEN concat('{{"content":{{"a":1}},"other":', {_quoted('text')}, '}}')
  WHEN 5 THEN '[]'
  ELSE '42' END"""


def _coerce_any(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    chunks = X.any_context(F.try_parse_json(F.expr(SHAPES)))
    return turns.select("conv_id", "turn", chunks.alias("c")).select(
        "conv_id",
        "turn",
        F.when(F.col("c").isNotNull(), F.size("c").cast("bigint")).alias("n_chunks"),
        R.join_context(F.col("c")).alias("raw_context"),
    )


def _typed(spark, sf_dir):
    return L.typed_responses(_events(spark, sf_dir, body=SCORED), "body")


def _typed_responses(spark, sf_dir):
    scores, decision = F.col("scores"), F.col("runtime_decision")
    return _typed(spark, sf_dir).select(
        "event_id", "request_id", "ok", "error", "risk_band", L.is_backfilled().alias("backfilled"),
        scores["primary_score"].alias("primary_score"), scores["support_units_used"].alias("support_units_used"),
        "groundedness_v2", decision["action"].alias("action"), decision["rollback_safe"].alias("rollback_safe"),
        F.array_join(decision["reason_codes"], ",").alias("reason_codes"),
        F.col("nli_diagnostics.aggregate_score").alias("nli_aggregate_score"),
        F.col("response_tokens")[0]["g_t"].alias("first_g_t"),
        F.try_variant_get("raw", "$.extra", "bigint").alias("extra"),
    )


def _trace_records(spark, sf_dir):
    typed = L.typed_responses(_events(spark, sf_dir, body=TRACED), "body")
    record = F.try_parse_json(F.col("metadata"))
    part = lambda path, kind: F.try_variant_get(record, f"$.{path}", kind)
    return L.trace_records(typed).select(
        "event_id",
        F.array_join(F.array_sort(F.json_object_keys("metadata")), ",").alias("keys"),
        part("risk_band", "string").alias("risk_band"),
        *[part(c, "double").alias(c) for c in ("trace_score", "groundedness_v2", "coverage_score_u", "context_coverage_ratio")],
        part("request_id", "string").alias("request_id"),
        *[F.get_json_object("metadata", f"$.{c}").alias(c) for c in ("runtime_decision", "scores", "context_trust_diagnostics")],
        part("raw.trace_score", "double").alias("raw_score"),
    )


def _cited(spark, sf_dir):
    return L.cited_evidence(_typed(spark, sf_dir), "event_id").select("event_id", "index", "support_id", "coverage_score")


def _unsupported(spark, sf_dir):
    return L.unsupported_tokens(_typed(spark, sf_dir), "event_id").select("event_id", "token_index", "token", "heatmap_score")


def _json_rows(spark, sf_dir):
    events = read_table(spark, sf_dir, "events", "event_id", "event_type", "user_id", "value")
    return events.select(
        "event_id",
        F.to_json(
            F.struct(
                F.when(F.col("user_id") % 2 == 0, F.col("event_type")).alias("event_type"),
                F.when(F.col("event_id") % 3 != 0, F.col("user_id")).alias("user_id"),
                F.col("event_id").alias("x_event"),
            )
        ).alias("json"),
    )


def first_generation(items: DataFrame, key: str) -> DataFrame:
    """First non-empty text among the first items of each list of generations."""
    usable = items.filter((F.col("item_ix") == 0) & (F.col("text") != ""))
    return usable.groupBy(key).agg(F.min_by("text", "list_ix").alias("text"))


_GENERATIONS = {
    "list_ix": "event_id",
    "item_ix": "event_id % 2",
    "text": "CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type || '-' || CAST(event_id AS STRING) END",
}


def _generations(spark, sf_dir):
    events = read_table(spark, sf_dir, "events", "event_id", "user_id", "event_type")
    items = events.selectExpr("user_id", *[f"{e} AS {n}" for n, e in _GENERATIONS.items()])
    return first_generation(items, "user_id")


QUERIES = {
    "scan_interactions": _scan,
    "flatten_content": _content,
    "explode_units": _explode,
    "units_by_chunk_id": _by_chunk,
    "missing_chunk_ids": _missing_chunks,
    "normalize_envelopes": _envelopes,
    "normalize_rollup": _rollups,
    "classify_errors": _classified,
    "error_envelopes": _error_envelopes,
    "coerce_any_context": _coerce_any,
    "error_counts": lambda s, d: X.error_counts(_classified(s, d)),
    "typed_responses": _typed_responses,
    "trace_records": _trace_records,
    "cited_evidence": _cited,
    "unsupported_tokens": _unsupported,
    "to_json_rows": _json_rows,
    "coerce_context": _coerce,
    "validate_requests": _validate,
    "gate_skip": _skip,
    "gate_fail_closed": _closed,
    "gate_empty_input": _empty,
    "pick_response": _pick,
    "resolve_band": _bands(R.resolve_band),
    "resolve_band_strict": _bands(R.resolve_band_strict),
    "resolve_score": _score,
    "trace_metadata": _metadata,
    "route_by_band": _route,
    "reject_bands": _rejected,
    "accept_bands": _accepted,
    "block_on_red": _block,
    "first_generation": _generations,
    "union_lanes": _union_lanes,
}

_RESP = f"r AS (SELECT event_id, {_sql_columns(RESPONSES)} FROM events)"
_ANS = f"a AS (SELECT conv_id, turn, role, text, {_sql_columns(ANSWERS)} FROM conversations)"


def _norm(column: str, trim: bool = True) -> str:
    low = f"trim(lower({column}))" if trim else f"lower({column})"
    return (
        f"CASE {low} WHEN '' THEN NULL WHEN 'low' THEN 'green' WHEN 'medium' THEN 'amber' "
        f"WHEN 'high' THEN 'red' ELSE {low} END"
    )


_RESOLVED = (
    "coalesce(" + ", ".join(_norm(c) for c in ("risk_band", "scores_band", "band", "decision_band")) + ", 'unknown')"
)
_FIVE = "('green', 'amber', 'red', 'unknown', 'unsupported')"
_KNOWN = ", ".join(
    f"CASE WHEN {_norm(c, False)} IN {_FIVE} THEN {_norm(c, False)} END"
    for c in ("scores_band", "band", "decision_band")
)
_EMPTY = "(coalesce(answer, '') = '' OR coalesce(raw_context, '') = '')"
_ERR = f"""e AS (SELECT event_id, {STATUSES} AS status, CAST({ERRORS} AS JSON) AS b FROM events),
e1 AS (SELECT *, CASE WHEN json_type(b, '$.detail') = 'OBJECT' THEN json_extract(b, '$.detail') ELSE b END AS v FROM e),
e2 AS (
  SELECT *, CASE WHEN json_type(b, '$.detail') = 'VARCHAR' THEN b->>'$.detail' END AS plain,
         coalesce(v->>'$.code', v->>'$.error_code') AS c, coalesce(nullif(v->>'$.message', ''), v->>'$.error') AS said,
         json_type(b, '$.detail') = 'ARRAY' AND status = 422 AS listed,
         CASE WHEN b->>'$.detail[0].loc[0]' IS NOT NULL
              THEN 'validation error at ' || (b->>'$.detail[0].loc[0]') || '.' || (b->>'$.detail[0].loc[1]') || ': ' || (b->>'$.detail[0].msg')
              WHEN coalesce(json_type(b, '$.detail[0]'), '') <> 'OBJECT' THEN 'validation error: ' || json_extract(b, '$.detail')::VARCHAR
              ELSE 'validation error: ' || coalesce(b->>'$.detail[0].msg', 'validation error') END AS invalid
  FROM e1),
ec AS (
  SELECT event_id, CASE WHEN status IN (401, 402, 403) THEN 'auth' WHEN status = 422 THEN 'validation'
           WHEN status = 429 THEN 'rate_limited' WHEN status BETWEEN 500 AND 599 THEN 'server' ELSE 'api' END AS error_class,
         CASE WHEN plain IS NOT NULL THEN 'error' WHEN c IS NOT NULL OR said IS NOT NULL THEN coalesce(c, 'error') END AS code,
         coalesce(plain, nullif(said, ''), CASE WHEN listed THEN invalid END, 'HTTP ' || status) AS message,
         CASE WHEN plain IS NULL THEN v->>'$.hint' END AS hint
  FROM e2)"""
_CHUNK_REQ = """cr AS (
  SELECT conv_id, turn, unnest(['doc-' || (conv_id * 7 + turn), 'doc-' || (conv_id * 31)]) AS chunk_id FROM conversations),
bc AS (SELECT cr.*, text FROM cr JOIN documents ON chunk_id = 'doc-' || doc_id)"""

ORACLES = {
    "scan_interactions": """SELECT conv_id, turn, text AS response_text, CASE WHEN turn % 2 = 1 THEN role END AS raw_context,
       CASE WHEN conv_id % 3 = 0 THEN 'en' END AS language, turn AS evidence_limit, CAST(2 AS BIGINT) AS n_units,
       text AS first_unit, 'v' || conv_id AS unlisted FROM conversations""",
    "flatten_content": """SELECT conv_id, turn,
       CASE WHEN turn % 3 = 0 THEN text WHEN turn % 3 = 1 THEN text || chr(10) || role
            WHEN conv_id % 2 = 0 THEN text || chr(10) || 'tail' WHEN conv_id % 4 = 1 THEN text ELSE '' END AS content FROM conversations""",
    "explode_units": S.with_(S.REQUESTS)
    + """SELECT resp_id, unit_ix, text, source_id, CASE WHEN unit_ix % 2 = 0 THEN 'user' END AS speaker,
       CASE WHEN unit_ix % 3 = 0 THEN '2024-01-01 00:00:00' END AS said_at,
       CAST(unit_ix AS VARCHAR) AS meta_ix FROM un""",
    "units_by_chunk_id": S.with_(_CHUNK_REQ) + "SELECT * FROM bc",
    "missing_chunk_ids": S.with_(_CHUNK_REQ)
    + "SELECT * FROM cr WHERE chunk_id NOT IN (SELECT 'doc-' || doc_id FROM documents)",
    "normalize_envelopes": f"""WITH e AS (
  SELECT event_id, TRY_CAST({BODIES} AS JSON) AS b, CASE WHEN event_id % 16 = 0 THEN 'hdr' END AS header FROM events),
w AS (
  SELECT *, upper(coalesce(b->>'$.status', '')) AS st,
         json_type(b, '$.status') IS NOT NULL AND (json_type(b, '$.output') IS NOT NULL OR json_type(b, '$.error') IS NOT NULL) AS wrapped
  FROM e),
o AS (
  SELECT *, wrapped AND st NOT IN ('COMPLETED', 'COMPLETED_WITH_ERRORS') AS unfinished,
         CASE WHEN wrapped THEN json_extract(b, '$.output') ELSE b END AS out FROM w),
p AS (
  SELECT *, CASE WHEN json_type(out, '$.result') = 'OBJECT' THEN json_extract(out, '$.result') ELSE out END AS pay,
         CASE WHEN b IS NULL THEN 'response is not JSON' WHEN unfinished THEN 'job ' || lower(st) || ': ' || coalesce(nullif(b->>'$.error', ''), nullif(b->>'$.output', ''), b::VARCHAR)
              WHEN json_type(out, '$.success') = 'BOOLEAN' AND out->>'$.success' = 'false'
              THEN coalesce(nullif(out->>'$.error', ''), nullif(out->>'$.message', ''), 'job failed')
              WHEN coalesce(json_type(out), 'NULL') = 'NULL' THEN 'job without output'
         END AS error FROM o)
SELECT event_id, coalesce(header, CASE WHEN json_type(b, '$.id') = 'VARCHAR' THEN b->>'$.id' END) AS request_id,
       error IS NULL AS ok, error, CASE WHEN error IS NULL THEN pay->>'$.band' END AS band,
       CASE WHEN error IS NULL THEN CAST(pay->>'$.score' AS DOUBLE) END AS score
FROM p""",
    "typed_responses": """WITH e AS (SELECT event_id, event_type, event_id % 8 AS k FROM events)
SELECT event_id, CASE k WHEN 1 THEN 'j' || event_id WHEN 2 THEN 'inner' END AS request_id,
       k NOT IN (4, 6, 7) AS ok,
       CASE k WHEN 4 THEN 'schema_error' WHEN 6 THEN 'job failed: boom' WHEN 7 THEN 'response is not JSON' END AS error,
       CASE k WHEN 0 THEN 'red' WHEN 1 THEN 'amber' WHEN 2 THEN 'green' WHEN 3 THEN 'red' END AS risk_band,
       k IN (1, 2, 3) AS backfilled,
       CASE WHEN k = 0 THEN (event_id % 10)::DOUBLE / 10 END AS primary_score,
       CASE WHEN k = 0 THEN 4::BIGINT END AS support_units_used,
       CASE k WHEN 1 THEN 0.62::DOUBLE WHEN 4 THEN 1::DOUBLE END AS groundedness_v2,
       CASE k WHEN 0 THEN 'block' WHEN 3 THEN 'warn' END AS action,
       CASE WHEN k = 0 THEN true END AS rollback_safe,
       CASE WHEN k = 0 THEN 'a,b:' || event_type END AS reason_codes,
       CASE k WHEN 3 THEN 0.5::DOUBLE WHEN 5 THEN 0.75::DOUBLE END AS nli_aggregate_score,
       CASE WHEN k = 5 THEN 0.25::DOUBLE END AS first_g_t,
       CASE WHEN k = 0 THEN event_id END AS extra
FROM e""",
    "trace_records": """SELECT event_id,
       CASE event_id % 4 WHEN 0 THEN 'context_coverage_ratio,context_trust_diagnostics,coverage_score_u,groundedness_v2,raw,request_id,risk_band,runtime_decision,scores,trace_score'
            WHEN 1 THEN 'raw,risk_band,scores,trace_score' WHEN 2 THEN 'risk_band,trace_score' ELSE 'raw,risk_band,trace_score' END AS keys,
       CASE event_id % 4 WHEN 2 THEN 'unknown' WHEN 3 THEN 'amber' ELSE 'red' END AS risk_band,
       CASE event_id % 4 WHEN 0 THEN (event_id % 10)::DOUBLE / 10 WHEN 1 THEN 0.125::DOUBLE WHEN 2 THEN 0::DOUBLE ELSE 0.875::DOUBLE END AS trace_score,
       CASE WHEN event_id % 4 = 0 THEN 0.5::DOUBLE END AS groundedness_v2, CASE WHEN event_id % 4 = 0 THEN 0.25::DOUBLE END AS coverage_score_u,
       CASE WHEN event_id % 4 = 0 THEN 0.75::DOUBLE END AS context_coverage_ratio, CASE WHEN event_id % 4 = 0 THEN 'r' || event_id END AS request_id,
       CASE WHEN event_id % 4 = 0 THEN '{"action":"block","reason_codes":["' || event_type || '"]}' END AS runtime_decision,
       CASE event_id % 4 WHEN 0 THEN '{"groundedness_v2":0.5,"coverage_score_u":0.25,"context_coverage_ratio":0.75}'
            WHEN 1 THEN '{"groundedness_v1":0.125,"risk_band":" HIGH "}' END AS scores,
       CASE WHEN event_id % 4 = 0 THEN '{"n":' || event_id || ',"state":"' || event_type || '"}' END AS context_trust_diagnostics,
       CASE WHEN event_id % 4 = 0 THEN (event_id % 10)::DOUBLE / 10 END AS raw_score
FROM events""",
    "cited_evidence": """SELECT event_id, i AS "index", CASE i WHEN 0 THEN 's0' ELSE 's' || event_id END AS support_id,
       CASE WHEN i = 0 THEN 0.3::DOUBLE END AS coverage_score
FROM events, (VALUES (0::BIGINT), (1::BIGINT)) v(i) WHERE event_id % 8 = 0""",
    "unsupported_tokens": """SELECT event_id, 12::BIGINT AS token_index, event_type AS token, 0.1::DOUBLE AS heatmap_score
FROM events WHERE event_id % 8 = 0""",
    "normalize_rollup": """SELECT event_id,
       CASE WHEN event_id % 5 IN (0, 1) THEN event_id END AS turns,
       CASE WHEN event_id % 5 = 0 THEN 0.25::DOUBLE END AS noise_pct,
       CASE event_id % 5 WHEN 0 THEN 'noise_pct,turns' WHEN 1 THEN 'id,session_id,turns' WHEN 2 THEN 'extra'
            WHEN 3 THEN 'other' ELSE 'rollup' END AS keys FROM events""",
    "classify_errors": S.with_(_ERR) + "SELECT * FROM ec",
    "error_envelopes": """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'E0' WHEN 1 THEN 'E1' WHEN 2 THEN 'error' END AS code,
       CASE event_id % 4 WHEN 0 THEN 'm' WHEN 1 THEN 'slow down' WHEN 2 THEN 'gone' ELSE 'HTTP 500' END AS message,
       CASE WHEN event_id % 4 = 0 THEN 'https://d/' || event_type END AS docs_url,
       CASE event_id % 4 WHEN 0 THEN 'note=n;trace={"id":' || event_id || '}' WHEN 1 THEN 'retry=' || event_id || ';success=false'
            WHEN 2 THEN '' END AS extra FROM events""",
    "coerce_any_context": """SELECT conv_id, turn, nullif(len(c), 0) AS n_chunks, CASE WHEN len(c) > 0 THEN array_to_string(c, chr(10) || chr(10)) END AS raw_context
FROM (SELECT conv_id, turn, list_filter(CASE turn % 7 WHEN 0 THEN [text] WHEN 2 THEN [coalesce(nullif(role, ''), text)] WHEN 3 THEN [text, role, 't']
             ELSE []::VARCHAR[] END, lambda x: x IS NOT NULL AND x <> '') AS c FROM conversations)""",
    "error_counts": S.with_(_ERR) + "SELECT error_class, code, count(*) AS n FROM ec GROUP BY ALL",
    "to_json_rows": """SELECT event_id, '{' || concat_ws(',',
         CASE WHEN user_id % 2 = 0 THEN '"event_type":"' || event_type || '"' END,
         CASE WHEN event_id % 3 <> 0 THEN '"user_id":' || user_id END, '"x_event":' || event_id) || '}' AS json FROM events""",
    "coerce_context": """WITH c AS (
  SELECT conv_id, turn, list_filter(CASE WHEN conv_id % 7 = 3 THEN [NULL] ELSE [
      coalesce(nullif(CASE WHEN turn % 2 = 0 THEN text ELSE '' END, ''), nullif(CASE WHEN turn % 3 = 0 THEN role END, ''), nullif(text, '')),
      CASE WHEN conv_id % 2 = 0 THEN role END] END, lambda x: x IS NOT NULL) AS l FROM conversations)
SELECT conv_id, turn, nullif(len(l), 0) AS n_chunks,
       CASE WHEN len(l) > 0 THEN array_to_string(l, chr(10) || chr(10)) END AS raw_context FROM c""",
    "validate_requests": S.with_(
        _ANS,
        """v AS (SELECT *, CASE WHEN response_text IS NULL THEN 'response_text is required'
             WHEN language <> locale THEN 'pass either language or locale, not both' END AS reason,
         (coalesce(raw_context, '') <> '')::INT + (result IS NOT NULL)::INT AS given FROM a)""",
    )
    + """SELECT conv_id, turn, CASE WHEN reason IS NULL THEN coalesce(language, locale) END AS language, reason,
       CASE WHEN reason IS NOT NULL THEN NULL WHEN given = 0 THEN 'no_premise_lane' WHEN given > 1 THEN 'several_premise_lanes' END AS warning
FROM v""",
    "gate_skip": S.with_(_ANS)
    + """SELECT conv_id, turn, answer, raw_context FROM a
WHERE answer <> '' AND NOT (closed_book AND coalesce(raw_context, '') = '')""",
    "gate_fail_closed": S.with_(_ANS)
    + f"""SELECT conv_id, turn, CASE WHEN {_EMPTY} OR error IS NOT NULL THEN 'red' ELSE band END AS trace_band,
       CASE WHEN {_EMPTY} OR error IS NOT NULL THEN 0.0 ELSE score END AS trace_score FROM a""",
    "gate_empty_input": S.with_(_ANS)
    + f"""SELECT conv_id, turn, CASE WHEN {_EMPTY} THEN 'red' WHEN error IS NOT NULL THEN 'amber' ELSE band END AS band,
       CASE WHEN {_EMPTY} THEN 0.0 WHEN error IS NOT NULL THEN NULL ELSE score END AS groundedness,
       CASE WHEN {_EMPTY} THEN 'empty_input' WHEN error IS NOT NULL THEN error END AS reason FROM a""",
    "pick_response": S.with_(_ANS)
    + """SELECT conv_id, turn, coalesce(output, answer, text, result, '') AS chain_response,
       coalesce(nullif(answer, ''), nullif(result, ''), '') AS graph_response FROM a""",
    "resolve_band": S.with_(_RESP) + f"SELECT event_id, {_RESOLVED} AS resolved FROM r",
    "resolve_band_strict": S.with_(_RESP)
    + f"""SELECT event_id, CASE WHEN risk_band IN {_FIVE} THEN risk_band WHEN risk_band IS NOT NULL THEN 'schema_error'
       ELSE coalesce({_KNOWN}) END AS resolved FROM r""",
    "resolve_score": S.with_(_RESP)
    + f"SELECT event_id, coalesce({', '.join(f'TRY_CAST({c} AS DOUBLE)' for c in _SCORES)}, 0.0) AS resolved FROM r",
    "trace_metadata": S.with_(_RESP)
    + f"""SELECT event_id, '{{' || concat_ws(',', CASE WHEN groundedness_v2 IS NOT NULL THEN '"groundedness_v2":"' || groundedness_v2 || '"' END,
       CASE WHEN event_id % 2 = 0 THEN '"request_id":' || event_id END, '"risk_band":"' || {_RESOLVED} || '"') || '}}' AS metadata FROM r""",
    "route_by_band": S.with_(_RESP)
    + f"""SELECT event_id, CASE {_RESOLVED} WHEN 'green' THEN 'pass' WHEN 'red' THEN 'retry' ELSE 'review' END AS route FROM r""",
    "reject_bands": S.with_(_ANS) + "SELECT conv_id, turn, band FROM a WHERE band IN ('red', 'unknown')",
    "accept_bands": S.with_(_ANS) + "SELECT conv_id, turn, band FROM a WHERE band NOT IN ('red', 'unknown')",
    "block_on_red": S.with_(_ANS)
    + f"SELECT conv_id, turn, CASE WHEN band = 'red' THEN '{R.SAFE_REPLY.replace(chr(39), chr(39) * 2)}' ELSE text END AS reply FROM a",
    "first_generation": f"""SELECT user_id, arg_min(text, list_ix) AS text
FROM (SELECT user_id, {_sql_columns(_GENERATIONS)} FROM events) WHERE item_ix = 0 AND text <> '' GROUP BY user_id""",
    "union_lanes": S.with_(
        S.REQUESTS,
        _CHUNK_REQ,
        S.token_rows("tok", "documents", "doc_id", "text"),
        "ch AS (SELECT doc_id, ix // 64 AS chunk_ix, min(char_start) AS s, max(char_end) AS e FROM tok GROUP BY ALL)",
    )
    + """SELECT 'd' || resp_id AS resp_id, unit_ix, source_id, text, 'support_units' AS lane FROM un
UNION ALL SELECT 'd' || ch.doc_id, chunk_ix, NULL, substring(text, s + 1, e - s), 'raw_context' FROM ch JOIN documents USING (doc_id)
UNION ALL SELECT conv_id || ':' || turn, NULL, chunk_id, text, 'chunk_ids' FROM bc""",
}
