"""Streaming queries: each runs what is there and reads its output table back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.clock import instant
from plumbline.operators import sessions as N
from plumbline.plans import privacy_plans, session_plans
from plumbline.session import scratch_path
from plumbline.sources import sinks
from plumbline.sources.tables import read_table
from plumbline.streaming import stateful, streams, trend


def _stream(spark, sf_dir, name: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return streams.table_stream(spark, sf_dir, f"{name}.parquet", schema)


def _events(spark, sf_dir) -> DataFrame:
    return _stream(spark, sf_dir, "events").withColumn("at", instant("ts"))


def _redact(spark, sf_dir):
    docs = _stream(spark, sf_dir, "documents").select("doc_id", "text")
    out = streams.redact_stream(docs.repartition(spark.sparkContext.defaultParallelism))
    return streams.run_to_table(
        out.select(
            "doc_id", "redacted_text", "entity_count", F.array_join("unique_labels", ",").alias("unique_labels")
        ),
        "stream-redact",
    )


def _dedup(spark, sf_dir):
    keyed = _events(spark, sf_dir).select("user_id", "event_type", F.to_date("ts").alias("day"), "at")
    out = streams.dedup_stream(keyed, ["user_id", "event_type", "day"], "at", "2 days")
    return streams.run_to_table(out.drop("at"), "stream-dedup")


def _tumbling(spark, sf_dir):
    out = streams.window_counts(_events(spark, sf_dir), "at", ["event_type"], "1 hour", "1 day")
    return streams.run_to_table(out, "stream-tumbling")


def _sliding(spark, sf_dir):
    out = streams.window_counts(_events(spark, sf_dir), "at", ["event_type"], "1 hour", "1 day", "12 hours")
    return streams.run_to_table(out, "stream-sliding")


def _sessions(spark, sf_dir):
    out = streams.session_counts(_events(spark, sf_dir), "at", "user_id", "1 hour", "2 hours")
    return streams.run_to_table(out, "stream-sessions")


def _outcomes(spark, sf_dir) -> DataFrame:
    return _stream(spark, sf_dir, "events").select(
        "user_id", "event_id", F.round(F.col("value") / 1000, 6).alias("score"), instant("ts").alias("at")
    )


def _rollup(spark, sf_dir):
    parts = streams.rollup_parts(_outcomes(spark, sf_dir), "user_id", "event_id", "score", "at")
    return streams.session_rollup(streams.run_updates(parts, "stream-rollup", ["user_id", "_period"]), "user_id")


def _drift(spark, sf_dir):
    outcomes = _outcomes(spark, sf_dir).select(
        F.col("user_id").alias("session"), F.col("event_id").alias("turn"), "score", "at"
    )
    return streams.run_to_table(stateful.drift_stream(outcomes), "stream-drift")


def _trend(spark, sf_dir):
    outcomes = _outcomes(spark, sf_dir).select(
        F.col("user_id").alias("session"), F.col("event_id").alias("turn"), "score", "at"
    )
    with trend.rocksdb(spark):
        return streams.run_to_table(trend.trend_stream(outcomes), "stream-trend")


def _join_scores(spark, sf_dir):
    """Requests and, as a second stream, their scores: late ones and missing ones among them."""
    events = _events(spark, sf_dir)
    requests = events.select(F.col("event_id").alias("request_id"), F.col("user_id").alias("session"), "at")
    scores = _events(spark, sf_dir).filter("event_id % 4 <> 0").select(
        F.col("event_id").alias("request_id"),
        F.round(F.col("value") / 1000, 6).alias("score"),
        F.timestamp_micros(F.unix_micros("at") + (F.col("event_id") % 9) * 600_000_000).alias("scored_at"),
    )
    joined = streams.join_scores(requests, scores, ["request_id"], "1 hour")
    shaped = joined.select(
        "request_id", "session", "score", (F.unix_seconds("scored_at") - F.unix_seconds("at")).alias("waited_s")
    )
    return streams.run_to_table(shaped, "stream-join")


def _sink(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    scores = N.turn_scores(turns).withColumnRenamed("band", "risk_band")
    path = scratch_path(spark, "results")
    sinks.write_results(scores, path)
    return spark.read.schema(scores.schema).parquet(path)


QUERIES = {
    "sink_roundtrip": _sink,
    "stream_redact": _redact,
    "stream_dedup": _dedup,
    "stream_tumbling": _tumbling,
    "stream_sliding": _sliding,
    "stream_sessions": _sessions,
    "stream_rollup": _rollup,
    "stream_drift": _drift,
    "stream_trend": _trend,
    "stream_join_scores": _join_scores,
}

_CLOSED = "WHERE end_s * 1000 <= (SELECT epoch_ms(max(ts)) - 3600000 FROM events)"

ORACLES = {
    "sink_roundtrip": session_plans.ORACLES["conversation_bands"].replace(
        "SELECT * FROM sc", "SELECT * RENAME (band AS risk_band) FROM sc"
    ),
    "stream_redact": privacy_plans.ORACLES["redact_mask"],
    "stream_dedup": "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events",
    "stream_tumbling": f"SELECT * FROM ({session_plans.ORACLES['tumbling_counts']}) {_CLOSED}",
    "stream_sliding": f"SELECT * FROM ({session_plans.ORACLES['sliding_counts']}) {_CLOSED}",
    "stream_sessions": """SELECT user_id, start_us, end_us, n_events FROM (
  SELECT user_id, min(s) AS start_us, max(s) + 7200000000 AS end_us, count(*) AS n_events
  FROM (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS UNBOUNDED PRECEDING) AS g
        FROM (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY user_id ORDER BY s, event_id) < 7200000000 THEN 0 ELSE 1 END AS o
              FROM (SELECT user_id, event_id, epoch_us(ts) AS s FROM events))) GROUP BY user_id, g)
WHERE end_us // 1000 <= (SELECT epoch_ms(max(ts)) - 3600000 FROM events)""",
    "stream_rollup": """WITH o AS (
  SELECT user_id, event_id, round(value / 1000, 6) AS score,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS back FROM events)
SELECT user_id, count(*) AS turns, round(avg((score >= 0.2 AND score < 0.35)::INT), 6) AS noise_pct,
       floor(sum(round(score * 1000000)::BIGINT)::DOUBLE / count(*) + 0.5) / 1000000 AS mean_score, arg_max(score, event_id) AS last_score,
       coalesce(round(CASE WHEN count(*) > 2 AND stddev_samp(score) FILTER (back > 1) > 0
         THEN (arg_max(score, event_id) - avg(score) FILTER (back > 1)) / stddev_samp(score) FILTER (back > 1) ELSE 0.0 END, 6), 0.0) AS z_last
FROM o GROUP BY user_id""",
    "stream_drift": """SELECT user_id AS session, event_id AS turn, score,
       coalesce(round(CASE WHEN c >= 2 AND d > 1e-9 THEN (score - m) / d ELSE 0.0 END, 6), 0.0) AS z
FROM (SELECT *, count(*) OVER w AS c, avg(score) OVER w AS m, stddev_samp(score) OVER w AS d
      FROM (SELECT user_id, event_id, round(value / 1000, 6) AS score FROM events)
      WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
    "stream_trend": """WITH o AS (
  SELECT user_id AS session, event_id AS turn, ts, round(value / 1000, 6) AS score,
         CASE WHEN score IS NULL THEN 'unknown' WHEN score >= 0.35 THEN 'green' WHEN score >= 0.2 THEN 'amber' ELSE 'red' END AS band
  FROM events),
w AS (
  SELECT *, count(score) OVER p AS c, avg(score) OVER p AS m, stddev_samp(score) OVER p AS d,
         CASE WHEN lag(band) OVER (PARTITION BY session ORDER BY ts, turn) = band THEN 0 ELSE 1 END AS starts
  FROM o WINDOW p AS (PARTITION BY session ORDER BY ts, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
r AS (SELECT *, CAST(sum(starts) OVER (PARTITION BY session ORDER BY ts, turn) AS BIGINT) - 1 AS run_ix FROM w)
SELECT session, turn, score, coalesce(round(CASE WHEN c >= 2 AND d > 1e-9 THEN (score - m) / d ELSE 0.0 END, 6), 0.0) AS z,
       band, run_ix, run_turns
FROM (SELECT *, row_number() OVER (PARTITION BY session, run_ix ORDER BY ts, turn) AS run_turns FROM r)
WHERE epoch_ms(ts) <= (SELECT epoch_ms(max(ts)) - 3600000 FROM events)""",
    "stream_join_scores": """WITH q AS (SELECT event_id AS request_id, user_id AS session, epoch_us(ts) AS asked FROM events),
s AS (SELECT event_id AS request_id, round(value / 1000, 6) AS score, epoch_us(ts) + event_id % 9 * 600000000 AS scored_at
      FROM events WHERE event_id % 4 <> 0),
w AS (SELECT least((SELECT max(asked) FROM q), (SELECT max(scored_at) FROM s)) // 1000 * 1000 - 3600000000 AS passed),
j AS (SELECT q.request_id, session, asked, score, scored_at
      FROM q LEFT JOIN s ON s.request_id = q.request_id AND scored_at BETWEEN asked AND asked + 3600000000)
SELECT request_id, session, score, (scored_at - asked) // 1000000 AS waited_s
FROM j, w WHERE scored_at IS NOT NULL OR asked + 3600000000 < passed""",
}
