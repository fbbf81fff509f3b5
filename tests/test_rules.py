"""Record rules on small frames, with the expected rows written out."""

import pytest
from pyspark.sql import functions as F

from plumbline.functions import rules as R
from plumbline.sources import envelopes as X
from plumbline.sources.interactions import context_chunks, exchange_units, pair_turns


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def text(value):
    return F.lit(value).cast("string")


@pytest.mark.parametrize(
    "given, want",
    [
        ((None, "green", None, None), "green"),
        ((None, None, "amber", None), "amber"),
        ((None, None, None, "amber"), "amber"),
        (("LOW", "red", None, None), "green"),
        ((" High ", None, None, None), "red"),
        (("", "  ", "\n", None), "unknown"),
        (("violet", None, None, None), "violet"),
    ],
)
def test_resolve_band(spark, given, want):
    assert one(spark, R.resolve_band(*map(text, given))) == want


@pytest.mark.parametrize(
    "given, want",
    [
        (("amber", "red", None, None), "amber"),
        (("low", None, None, None), "schema_error"),
        ((None, "violet", "LOW", None), "green"),
        ((None, " red", None, "red"), "red"),
        ((None, None, None, None), None),
    ],
)
def test_resolve_band_strict(spark, given, want):
    assert one(spark, R.resolve_band_strict(*map(text, given))) == want


@pytest.mark.parametrize(
    "given, want",
    [((None, None, "0.82"), 0.82), (("n/a", "0.4", None), 0.4), ((None, None, None), 0.0)],
)
def test_resolve_score(spark, given, want):
    assert one(spark, R.resolve_score(*map(text, given))) == want


def test_context_joins_chunks_without_a_separator_for_one(spark):
    items = F.array(
        F.struct(text("Newton was born in 1643.").alias("page_content"), text("").alias("content"), text(None).alias("text"))
    )
    assert one(spark, R.join_context(R.coerce_context(items))) == "Newton was born in 1643."


def test_language_rules(spark):
    reason = R.reject_reason(text("a"), text("de"), text("en"))
    assert one(spark, reason) == "pass either language or locale, not both"
    assert one(spark, R.canonical_language(text(None), text("en"))) == "en"
    assert one(spark, R.reject_reason(text(None), text(None), text(None))) == "response_text is required"


def test_content_parts(spark):
    assert one(spark, R.flatten_content(text('"plain"'))) == "plain"
    assert one(spark, R.flatten_content(text('[{"type":"text","text":"a"},{"type":"image"},"b",{"type":"text"}]'))) == "a\nb\n"
    assert one(spark, R.flatten_content(text(None))) == ""


def test_envelopes(spark):
    bodies = [
        '{"id":"j1","status":"COMPLETED","output":{"result":{"band":"red"}}}',
        '{"id":7,"status":"FAILED","error":"boom"}',
        '{"band":"green"}',
        '{"status":"COMPLETED","output":{"success":false}}',
    ]
    logs = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    rows = X.normalize_envelopes(logs, "body").orderBy("i").collect()
    assert [r["ok"] for r in rows] == [True, False, True, False]
    assert [r["request_id"] for r in rows] == ["j1", None, None, None]
    assert [r["error"] for r in rows] == [None, "job failed: boom", None, "job failed"]


def test_errors(spark):
    logs = spark.createDataFrame(
        [
            (402, '{"detail":{"code":"license_missing","message":"none"}}'),
            (422, '{"detail":[{"loc":["body","response_text"],"msg":"Field required"}]}'),
            (503, "not json"),
            (429, '{"error_code":"E1","error":"slow down"}'),
            (404, '{"detail":"gone"}'),
        ],
        "status int, body string",
    )
    rows = {r["status"]: r for r in X.classify_errors(logs, "status", "body").collect()}
    assert (rows[402]["error_class"], rows[402]["code"]) == ("auth", "license_missing")
    assert rows[422]["message"] == "validation error at body.response_text: Field required"
    assert (rows[503]["error_class"], rows[503]["message"], rows[503]["code"]) == ("server", "HTTP 503", None)
    assert (rows[429]["error_class"], rows[429]["message"]) == ("rate_limited", "slow down")
    assert (rows[404]["error_class"], rows[404]["code"], rows[404]["message"]) == ("api", "error", "gone")


def test_pairing_on_uneven_conversations(spark):
    turns = spark.createDataFrame(
        [
            (1, 0, "system", "s0"), (1, 1, "user", "u1"), (1, 2, "user", "u2"), (1, 3, "assistant", "a3"),
            (1, 4, "system", ""), (1, 5, "system", "s5"), (1, 6, "assistant", "a6"), (2, 0, "assistant", "x"),
        ],
        "conv_id bigint, turn bigint, role string, text string",
    )
    pairs = {(r["conv_id"], r["turn"]): r for r in pair_turns(turns).collect()}
    assert pairs[1, 3]["query_text"] == "u2" and pairs[1, 3]["n_context"] == 1
    assert pairs[1, 6]["query_text"] == "u2" and pairs[1, 6]["n_context"] == 2
    assert pairs[2, 0]["query_text"] is None and pairs[2, 0]["n_context"] is None
    chunks = {(r["chunk_ix"], r["text"]) for r in context_chunks(turns).collect()}
    assert chunks == {(0, "s0"), (1, "s5")}
    units = {(r["resp_turn"], r["unit_ix"]) for r in exchange_units(turns).collect()}
    assert units == {(3, 0), (3, 1), (6, 3), (6, 4), (6, 5)}


def test_context_of_any_shape(spark):
    shapes = {
        '"one"': ["one"], '""': None, "null": None, "7": None, "[]": None, "true": None,
        '{"page_content":"","content":"c","text":"t"}': ["c"], '{"page_content":3,"text":"t"}': ["t"], '{"content":""}': None, "{}": None,
        '["a","",null,5,{"text":"b"},{"other":"x"},["c"],{"page_content":"d","text":"e"}]': ["a", "b", "d"], "[[],{}]": None, "not json": None,
    }
    rows = spark.createDataFrame([*((k,) for k in shapes), (None,)], "body string")
    got = {r.body: r.c for r in rows.select("body", X.any_context(F.try_parse_json("body")).alias("c")).collect()}
    assert got == {**shapes, None: None}


def test_errors_keep_docs_and_further_keys(spark):
    bodies = {
        '{"detail":{"code":"c","message":"m","docs_url":"u","x":[1,2],"hint":"h"}}': ("u", {"x": "[1,2]"}),
        '{"error":"e","status_code":500,"docs_url":null,"y":"s"}': (None, {"y": "s"}),
        '{"detail":"plain","docs_url":"u","x":1}': (None, {}),
        '{"docs_url":"u","x":1}': (None, None), "[1]": (None, None), "not json": (None, None),
    }
    rows = spark.createDataFrame([(500, k) for k in bodies], "status int, body string")
    got = {r.body: (r.docs_url, r.extra) for r in X.classify_errors(rows, "status", "body").collect()}
    assert got == bodies
