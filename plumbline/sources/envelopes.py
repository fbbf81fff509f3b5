"""Response, rollup and error logs of several wire shapes to one schema each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Job states that carry a result, keys of a rollup and of its
# envelope, statuses and their error class.
FINISHED = ("COMPLETED", "COMPLETED_WITH_ERRORS")
ROLLUP_KEYS = (
    "turns", "noise_pct", "model_drift_pct", "retrieval_waste_pct", "reason_code_histogram",
    "recommendations", "risk_band_trail", "drift_trend", "top_dead_files", "session_id",
    "heatmap", "heatmap_html", "request_id",
)
ENVELOPE_KEYS = ("success", "action", "version", "id")
AUTH = (401, 402, 403)
# Keys of an error that have a column of their own, and where a record keeps its text.
ERROR_KEYS = ("code", "message", "hint", "docs_url", "error_code", "error", "status_code")
TEXT_KEYS = ("page_content", "content", "text")


def _text(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def _kind(value: Column, path: str) -> Column:
    """OBJECT, ARRAY, STRING, ... of a field; null when it is missing."""
    return F.regexp_extract(F.schema_of_variant(F.try_variant_get(value, path, "variant")), "^[A-Z]+", 0)


def _string(value: Column, path: str) -> Column:
    """The field when it is a string."""
    return F.when(_kind(value, path) == "STRING", _text(value, path))


def _filled(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def normalize_envelopes(logs: DataFrame, body: str, header_id: str | None = None) -> DataFrame:
    """Job-wrapped and plain responses to ``request_id, ok, error, payload``.

    A body that is no JSON, a wrapper that did not finish (no status counts as
    unfinished) or has no output, and a payload whose ``success`` is the boolean false are errors.
    A header id wins over the wrapper's; an id that is no string is dropped.
    """
    v = F.col("_v")
    state = F.upper(F.coalesce(_text(v, "$.status"), F.lit("")))
    wrapped = _kind(v, "$.status").isNotNull() & (
        _kind(v, "$.output").isNotNull() | _kind(v, "$.error").isNotNull()
    )
    unfinished = wrapped & ~state.isin(*FINISHED)
    output = F.when(wrapped, F.try_variant_get(v, "$.output", "variant")).otherwise(v)
    staged = (
        logs.withColumn("_v", F.try_parse_json(F.col(body)))
        .withColumn("_output", output)
        .withColumn("_unfinished", F.coalesce(unfinished, F.lit(False)))
    )
    o = F.col("_output")
    refused = (_kind(o, "$.success") == "BOOLEAN") & (F.try_variant_get(o, "$.success", "boolean") == F.lit(False))
    missing = F.coalesce(_kind(o, "$"), F.lit("VOID")) == "VOID"
    detail = F.coalesce(
        _filled(_text(v, "$.error")), _filled(_text(v, "$.output")), F.col(body)
    )
    error = F.when(v.isNull(), "response is not JSON").when(
        F.col("_unfinished"), F.concat(F.lit("job "), F.lower(state), F.lit(": "), detail)
    ).when(
        refused,
        F.coalesce(_filled(_text(o, "$.error")), _filled(_text(o, "$.message")), F.lit("job failed")),
    ).when(missing, "job without output")
    payload = F.when(
        _kind(o, "$.result") == "OBJECT", F.try_variant_get(o, "$.result", "variant")
    ).otherwise(o)
    wrapper_id = _string(v, "$.id")
    request_id = F.coalesce(F.col(header_id), wrapper_id) if header_id else wrapper_id
    return (
        staged.withColumn("request_id", request_id)
        .withColumn("error", error)
        .withColumn("ok", F.col("error").isNull())
        .withColumn("payload", F.when(F.col("ok"), payload))
        .drop("_v", "_output", "_unfinished")
    )


def normalize_rollup(logs: DataFrame, body: str) -> DataFrame:
    """Wrapped and flat rollups to ``metrics``, a map of JSON values.

    A ``rollup`` object is taken as it is. Envelope keys are stripped only from a
    body that holds none of the known metrics.
    """
    v = F.try_parse_json(F.col(body))
    as_map = "map<string,string>"
    whole = F.from_json(F.col(body), as_map)
    known = F.exists(F.map_keys(whole), lambda k: k.isin(*ROLLUP_KEYS))
    inner = F.from_json(F.to_json(F.try_variant_get(v, "$.rollup", "variant")), as_map)
    return logs.withColumn(
        "metrics",
        F.when(_kind(v, "$.rollup") == "OBJECT", inner)
        .when(known, whole)
        .otherwise(F.map_filter(whole, lambda k, _: ~k.isin(*ENVELOPE_KEYS))),
    )


def any_context(value: Column) -> Column:
    """Texts of a context of any shape, given as a variant: a string, a record, or a list of both.

    A record gives the first of ``page_content``, ``content``, ``text`` that is a non-empty string.
    Empty strings and all else are skipped; null when nothing is left.
    """

    def one(item: Column) -> Column:
        record = F.coalesce(*[_filled(_string(item, f"$.{k}")) for k in TEXT_KEYS])
        return F.when(_kind(item, "$") == "STRING", _filled(_text(item, "$"))).when(_kind(item, "$") == "OBJECT", record)

    listed = F.transform(F.try_variant_get(value, "$", "array<variant>"), one)
    texts = F.array_compact(F.when(_kind(value, "$") == "ARRAY", listed).otherwise(F.array(one(value))))
    return F.when(F.size(texts) > 0, texts)


def classify_errors(logs: DataFrame, status: str, body: str) -> DataFrame:
    """HTTP status and error body to ``error_class, code, message, hint, docs_url, extra``.

    ``extra`` maps the further keys of a structured error to their values (nested ones as
    JSON); it is empty for a plain message and null where there is no envelope.
    """
    v = F.col("_v")
    staged = logs.withColumn("_v0", F.try_parse_json(F.col(body))).withColumn(
        "_v",
        F.when(
            _kind(F.col("_v0"), "$.detail") == "OBJECT",
            F.try_variant_get(F.col("_v0"), "$.detail", "variant"),
        ).otherwise(F.col("_v0")),
    )
    plain = _filled(_string(F.col("_v0"), "$.detail"))
    code = F.coalesce(_string(v, "$.code"), _string(v, "$.error_code"))
    said = F.coalesce(_filled(_string(v, "$.message")), _string(v, "$.error"))
    structured = code.isNotNull() | said.isNotNull()
    first = F.col("_v0")
    location = F.array_join(F.try_variant_get(first, "$.detail[0].loc", "array<string>"), ".")
    problem = F.coalesce(_filled(_text(first, "$.detail[0].msg")), F.lit("validation error"))
    listed = (F.col(status) == 422) & (_kind(first, "$.detail") == "ARRAY")
    whole = F.to_json(F.try_variant_get(first, "$.detail", "variant"))
    invalid = F.when(
        F.coalesce(_kind(first, "$.detail[0]"), F.lit("")) != "OBJECT", F.concat(F.lit("validation error: "), whole)
    ).when(
        _filled(location).isNotNull(),
        F.concat(F.lit("validation error at "), location, F.lit(": "), problem),
    ).otherwise(F.concat(F.lit("validation error: "), problem))
    message = F.coalesce(
        plain,
        _filled(said),
        F.when(listed, invalid),
        F.concat(F.lit("HTTP "), F.col(status).cast("string")),
    )
    whole_map = F.from_json(F.to_json(v), "map<string,string>")
    further = F.map_filter(whole_map, lambda k, _: ~k.isin(*ERROR_KEYS))
    none = F.create_map().cast("map<string,string>")
    return staged.select(
        *logs.columns,
        F.when(F.col(status).isin(*AUTH), "auth")
        .when(F.col(status) == 422, "validation")
        .when(F.col(status) == 429, "rate_limited")
        .when(F.col(status).between(500, 599), "server")
        .otherwise("api")
        .alias("error_class"),
        F.when(plain.isNotNull(), "error")
        .when(structured, F.coalesce(code, F.lit("error")))
        .alias("code"),
        message.alias("message"),
        F.when(plain.isNull() & structured, _string(v, "$.hint")).alias("hint"),
        F.when(plain.isNull() & structured, _string(v, "$.docs_url")).alias("docs_url"),
        F.when(plain.isNotNull(), none).when(structured, further).alias("extra"),
    )


def error_counts(classified: DataFrame) -> DataFrame:
    """How often each class and code occurs."""
    return classified.groupBy("error_class", "code").agg(F.count(F.lit(1)).alias("n"))
