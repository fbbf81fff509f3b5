"""Queries on sketches, learned heads and nested sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.operators import heads, nested, sketches
from plumbline.plans import sqlparts as S
from plumbline.session import scratch_path
from plumbline.sources.tables import read_table

QUANTILES = (0.1, 0.5, 0.9)


def _scores(spark, sf_dir):
    return read_table(spark, sf_dir, "events", "event_type", "user_id", "ts", "value").select(
        "event_type", "user_id", F.to_date("ts").alias("day"), F.round(F.col("value") / 1000, 6).alias("score")
    )


def _saved(spark, scores, by):
    """Daily sketches, written and read back."""
    path = scratch_path(spark, "sketches")
    sketches.save(sketches.daily(scores, by, "day", "score", "user_id"), path, "day")
    return sketches.load(spark, path)


def _quantiles(spark, sf_dir):
    scores = _scores(spark, sf_dir)
    out = sketches.checked_quantiles(
        scores, _saved(spark, scores, ["event_type"]), "event_type", "score", QUANTILES, 2 * sketches.rank_error()
    )
    return out.drop("estimate")


def _distinct(spark, sf_dir):
    scores = _scores(spark, sf_dir)
    out = sketches.checked_distinct(
        scores, _saved(spark, scores, ["event_type"]), "event_type", "user_id", sketches.distinct_error()
    )
    return out.drop("estimate")


FEATURES = ("n_tokens", "mean_length", "distinct_share", "digit_share")


def _features(spark, sf_dir):
    """Cheap lane features of documents."""
    text = F.col("text")
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text").withColumn("_t", T.tokens(text))
    n = F.size("_t")
    return docs.select(
        "doc_id",
        F.log(n + 1.0).alias("n_tokens"),
        F.try_divide(F.aggregate("_t", F.lit(0), lambda a, t: a + F.length(t)), n).alias("mean_length"),
        F.try_divide(F.size(F.array_distinct("_t")), n).alias("distinct_share"),
        F.try_divide(F.regexp_count(text, F.lit("[0-9]")), F.length(text)).alias("digit_share"),
    )


def _head(spark, sf_dir):
    rows = _features(spark, sf_dir).join(read_table(spark, sf_dir, "labels", "doc_id", "quality"), "doc_id", "left")
    head = heads.fit_head(rows.filter("doc_id % 5 <> 0"), FEATURES, "quality")
    return heads.apply_head(rows, head).select(
        "doc_id", "quality", "head_score", F.array_join("head_features_used", ",").alias("head_features_used")
    )


def _route(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", "doc_id", "lang", "text")
    model = heads.fit_route(docs.filter("doc_id % 5 <> 0"), "lang")
    out = heads.route(docs, "doc_id", model)
    shown = F.transform(F.map_entries("probabilities"), lambda e: F.format_string("%s=%.4f", e["key"], e["value"]))
    return out.select(
        "doc_id",
        F.col("class_key").alias("corpus_type"),
        F.round("confidence", 4).alias("confidence"),
        F.array_join(shown, ",").alias("probabilities"),
        F.array_join("top_classes", ",").alias("top_classes"),
    )


def _json_values(spark, sf_dir):
    """Events as prose with nested objects, quoted braces and braces without a partner."""
    rows = read_table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "props").select(
        "event_id",
        F.concat(
            F.lit('} seen {"user": {"id": '),
            "user_id",
            F.lit(', "tags": ["'),
            "event_type",
            F.lit('", "a, b} c"]}, "props": '),
            "props",
            F.lit(', "none": null} then {"done": true} and {open'),
        ).alias("text"),
    )
    found, _ = nested.objects(rows, ["event_id"])
    return nested.values(found, ["event_id"])


QUERIES = {
    "json_values": _json_values,
    "sketched_quantiles": _quantiles,
    "sketched_distinct": _distinct,
    "learned_head": _head,
    "bayes_route": _route,
}

ORACLES = {
    "json_values": """SELECT event_id, v.object_ix::BIGINT AS object_ix, v.path AS path, v.key AS key, v.value AS value
FROM (SELECT event_id, unnest([
  {object_ix: 0, path: '$.user.id', key: 'id', value: user_id::VARCHAR},
  {object_ix: 0, path: '$.user.tags[0]', key: 'tags', value: event_type},
  {object_ix: 0, path: '$.user.tags[1]', key: 'tags', value: 'a, b} c'},
  {object_ix: 0, path: '$.props.k', key: 'k', value: json_extract_string(props, '$.k')},
  {object_ix: 0, path: '$.none', key: 'none', value: NULL},
  {object_ix: 1, path: '$.done', key: 'done', value: 'true'}]) AS v FROM events)""",
    "sketched_quantiles": """SELECT event_type, at_ AS at, count(*) AS n, round(quantile_cont(score, at_), 6) AS exact, TRUE AS in_bound
FROM (SELECT event_type, round(value / 1000, 6) AS score, unnest([0.1, 0.5, 0.9]::DOUBLE[]) AS at_ FROM events) GROUP BY event_type, at_"""
    .replace("quantile_cont(score, at_)", "CASE at_ WHEN 0.1 THEN quantile_cont(score, 0.1) WHEN 0.5 THEN quantile_cont(score, 0.5) ELSE quantile_cont(score, 0.9) END")
    .replace(" AS at,", ' AS "at",'),
    "sketched_distinct": """SELECT event_type, count(DISTINCT user_id) AS exact, TRUE AS in_bound FROM events
GROUP BY GROUPING SETS ((event_type), ())""",
    "bayes_route": rf"""WITH tok AS (SELECT doc_id, lang, unnest({S.terms('text')}) AS term FROM documents),
cls AS (SELECT lang, ln(count(*) / sum(count(*)) OVER ()) AS prior FROM documents
        WHERE doc_id % 5 <> 0 AND lang IS NOT NULL AND regexp_matches(text, '[\p{{L}}\p{{N}}]') GROUP BY lang),
uses AS (SELECT term, lang, count(*) AS n FROM tok WHERE doc_id % 5 <> 0 AND lang IS NOT NULL GROUP BY ALL),
voc AS (SELECT DISTINCT term FROM uses),
mass AS (SELECT lang, ln(sum(n) + (SELECT count(*) FROM voc)) AS mass FROM uses GROUP BY lang),
dt AS (SELECT doc_id, term, count(*) AS n FROM tok SEMI JOIN voc USING (term) GROUP BY ALL),
sc AS (
  SELECT d.doc_id, c.lang, c.prior + coalesce(s, 0) AS score
  FROM (SELECT doc_id FROM documents) d CROSS JOIN cls c
  LEFT JOIN (SELECT dt.doc_id, m.lang, sum(dt.n * (ln(coalesce(u.n, 0) + 1) - mass)) AS s
             FROM dt CROSS JOIN mass m LEFT JOIN uses u ON u.term = dt.term AND u.lang = m.lang GROUP BY ALL) x
    ON x.doc_id = d.doc_id AND x.lang = c.lang),
pr AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) AS rk,
         round(exp(score - max(score) OVER (PARTITION BY doc_id)) / sum(exp(score - top)) OVER (PARTITION BY doc_id), 6) AS p
  FROM (SELECT *, max(score) OVER (PARTITION BY doc_id) AS top FROM sc))
SELECT doc_id, max(CASE WHEN rk = 1 THEN lang END) AS corpus_type, round(max(CASE WHEN rk = 1 THEN p END), 4) AS confidence,
       string_agg(printf('%s=%.4f', lang, p), ',' ORDER BY lang) AS probabilities,
       string_agg(lang, ',' ORDER BY rk) FILTER (rk <= 3) AS top_classes
FROM pr GROUP BY doc_id""",
}
