"""Session queries on conversations and events, and corpus-wide queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline import products
from plumbline.functions.clock import instant
from plumbline.operators import corpus as Q
from plumbline.operators import grounding as G
from plumbline.operators import late
from plumbline.operators import sessions as N
from plumbline.plans import sqlparts as S
from plumbline.session import materialise, scratch_path
from plumbline.sources import interactions as I
from plumbline.sources.sinks import SnapshotStore
from plumbline.sources.tables import read_table


def _turns(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")


def _events(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")


def _scores(spark, sf_dir) -> DataFrame:
    return N.turn_scores(_turns(spark, sf_dir))


def _on_saved_scores(operator):
    """For operators that read the scores in several branches."""
    return lambda spark, sf_dir: operator(materialise(_scores(spark, sf_dir), "scores"))


def _on_turns(operator):
    return lambda spark, sf_dir: operator(_turns(spark, sf_dir))


def _on_scores(operator):
    return lambda spark, sf_dir: operator(_scores(spark, sf_dir))


def _lane(column: str):
    def run(spark, sf_dir):
        return N.query_scores(_turns(spark, sf_dir)).select("conv_id", "turn", column)

    return run


def _triangular(spark, sf_dir):
    return N.query_scores(_turns(spark, sf_dir)).select(
        "conv_id", "turn", "reverse_context", "reverse_query_context", "echo_mean", "triangular"
    )


def _ema(spark, sf_dir):
    return N.file_usage(_turns(spark, sf_dir)).select("conv_id", "path", "ema_owner_share")


def _histogram(spark, sf_dir):
    rows = N.reason_histogram(_scores(spark, sf_dir))
    return rows.select(
        "conv_id",
        F.array_join(
            F.transform(
                F.map_entries("reason_code_histogram"),
                lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
            ),
            ",",
        ).alias("reason_codes"),
    )


def _recommend(spark, sf_dir):
    return N.recommendations(N.session_rollup(_turns(spark, sf_dir)))


DEDUP_KEY = "CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_type || '-' || CAST(CAST(ts AS DATE) AS STRING) END"


def _dedup(spark, sf_dir):
    events = _events(spark, sf_dir).selectExpr("user_id", "event_id", "value", f"{DEDUP_KEY} AS idempotency_key")
    return N.dedup_events(events, "user_id", "idempotency_key", ["event_id"])


def _snapshot(spark, sf_dir):
    event = F.concat_ws(":", "event_id", "event_type")
    pages = N.session_snapshot(
        _events(spark, sf_dir).withColumn("_e", event), "user_id", "event_id", F.col("_e"), 50
    )
    return pages.withColumn("events", F.array_join("events", ","))


def _snapshot_store(spark, sf_dir):
    """Saved, partly replaced, partly deleted, merged, and partly saved once more."""
    users = _events(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
    users = materialise(users, "users")
    store = SnapshotStore(spark, scratch_path(spark, "store"), users.schema, "user_id", buckets=8)
    store.save(users)
    store.save(users.filter("user_id % 3 = 0").withColumn("n_events", F.col("n_events") * 2))
    store.delete(users.filter("user_id % 5 = 0"))
    store.compact()
    store.save(users.filter("user_id % 7 = 0").withColumn("n_events", F.col("n_events") * 3))
    return store.all()


def _annotated(spark, sf_dir):
    turns = _turns(spark, sf_dir)
    pairs = I.pair_turns(turns).select(
        F.concat_ws(":", "conv_id", "turn").alias("resp_id"), "query_text"
    )
    units = I.exchange_units(turns).select(
        F.concat_ws(":", "conv_id", "resp_turn").alias("resp_id"),
        "unit_ix",
        "text",
        F.when(F.col("conv_id") % 5 == 0, "kept").alias("annotation"),
    )
    return G.annotate_nodes(pairs, units)


def _annotated_retrieval(spark, sf_dir):
    turns = _turns(spark, sf_dir)
    queries = I.pair_turns(turns).select(F.concat_ws(":", "conv_id", "turn").alias("resp_id"), "query_text")
    units = I.exchange_units(turns).select(
        F.concat_ws(":", "conv_id", "resp_turn").alias("resp_id"),
        "unit_ix",
        "source_id",
        "text",
        F.when(F.col("conv_id") % 5 == 0, "kept").alias("annotation"),
    )
    return products.annotate_retrieved(queries, units).select("resp_id", "unit_ix", "annotation")


def _exchange(spark, sf_dir):
    return I.exchange_units(_turns(spark, sf_dir)).select(
        "conv_id", "resp_turn", "unit_ix", "source_id", "text"
    )


def _maxsim(spark, sf_dir):
    sets = Q.vector_sets(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    units = sets.select((F.col("set_id") - 1).alias("resp_id"), "vectors")
    return Q.maxsim(sets.withColumnRenamed("set_id", "resp_id"), units)


def _vector_sets(spark, sf_dir):
    return Q.vector_sets(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def _maxsim_topk(spark, sf_dir):
    """Every set against all sets, over complete lists."""
    sets = _vector_sets(spark, sf_dir)
    return late.maxsim_topk(sets, sets, k=5, probes=late.CENTROIDS)


def _maxsim_recall(spark, sf_dir):
    """What the few probes of production find of the complete result."""
    sets = materialise(_vector_sets(spark, sf_dir), "sets")
    found = late.maxsim_topk(sets, sets, k=5)
    exact = late.maxsim_topk(sets, sets, k=5, probes=late.CENTROIDS)
    return late.recall(found, exact).drop("n_found")


def _open_domain(spark, sf_dir):
    items = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return Q.open_domain_topk(
        items.select(F.col("item_id").alias("resp_id"), F.col("text").alias("response_text")), docs
    )


def _entropy(spark, sf_dir):
    return Q.semantic_entropy(_events(spark, sf_dir), "user_id", "event_type")


def _entropy_text(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", "lang", "text")
    keyed = docs.select("lang", Q.answer_key(F.col("text")).alias("_key"))
    return Q.semantic_entropy(keyed, "lang", "_key")


def _event_drift(spark, sf_dir):
    events = _events(spark, sf_dir).withColumn("score", F.round(F.col("value") / 1000, 6))
    return N.drift_trend(events.select("user_id", "event_id", "score"), "user_id", "event_id", "score")


def _gap(spark, sf_dir):
    return N.gap_sessions(_events(spark, sf_dir), "user_id", "ts", 7200)


def _windows(slide: str | None):
    def run(spark, sf_dir):
        events = _events(spark, sf_dir).select(instant("ts").alias("ts"), "event_type")
        window = F.window("ts", "1 day", slide) if slide else F.window("ts", "1 day")
        return (
            events.groupBy(window.alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(
                F.unix_seconds("w.start").alias("start_s"),
                F.unix_seconds("w.end").alias("end_s"),
                "event_type",
                "n",
            )
        )

    return run


QUERIES = {
    "conversation_bands": _scores,
    "pair_turns": _on_turns(I.pair_turns),
    "context_chunks": _on_turns(I.context_chunks),
    "exchange_units": _exchange,
    "annotate_nodes": _annotated,
    "annotate_retrieved": _annotated_retrieval,
    "token_echo": _on_turns(N.token_echo),
    "query_tokens": _on_turns(N.query_tokens),
    "query_context": _lane("reverse_query_context"),
    "echo_mean": _lane("echo_mean"),
    "triangular": _triangular,
    "shared_tokens": _on_turns(N.shared_tokens),
    "trajectory_features": _on_saved_scores(N.trajectory_features),
    "turn_drift": _on_saved_scores(lambda scores: N.drift(scores).select("conv_id", "turn", "z")),
    "drift_trend": _on_saved_scores(N.drift_trend),
    "event_drift_trend": _event_drift,
    "ema_owner_share": _ema,
    "top_dead_files": lambda s, d: N.top_dead_files(N.file_usage(_turns(s, d))),
    "band_trail": _on_saved_scores(N.band_trail),
    "band_rollup": _on_scores(N.band_rollup),
    "session_rollup": _on_turns(N.session_rollup),
    "recommendations": _recommend,
    "reason_histogram": _histogram,
    "dedup_events": _dedup,
    "session_snapshot": _snapshot,
    "snapshot_store": _snapshot_store,
    "maxsim": _maxsim,
    "maxsim_topk": _maxsim_topk,
    "maxsim_recall": _maxsim_recall,
    "open_domain_topk": _open_domain,
    "semantic_entropy": _entropy,
    "semantic_entropy_text": _entropy_text,
    "tumbling_counts": _windows(None),
    "sliding_counts": _windows("12 hours"),
    "session_counts": _gap,
}

_PAIR = """pt AS (
  SELECT c.*, max(CASE WHEN role = 'user' THEN turn END) OVER w AS query_turn,
         nullif(count(*) FILTER (role = 'system' AND text <> '') OVER w, 0) AS n_context,
         count(*) OVER w AS n_units, count(*) FILTER (role = 'assistant') OVER w AS responses_before
  FROM conversations c
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
pr AS (SELECT * FROM pt WHERE role = 'assistant')"""
_TERMS = rf"""tt AS (
  SELECT conv_id, turn, role, term, count(*) AS n
  FROM (SELECT conv_id, turn, role, unnest({S.terms('text')}) AS term FROM conversations) GROUP BY ALL),
te AS (
  SELECT *, min(turn) OVER (PARTITION BY conv_id, term) AS origin,
         CASE WHEN min(turn) OVER (PARTITION BY conv_id, term) < turn THEN 1 ELSE 0 END AS g FROM tt),
tg AS (
  SELECT conv_id, turn, CAST(sum(n) AS BIGINT) AS n_tokens, round(sum(n * g) / sum(n), 6) AS share FROM te GROUP BY ALL)"""
_SCORED = """sc AS (
  SELECT pr.conv_id, pr.turn, coalesce(n_tokens, 0) AS n_tokens, share AS reverse_context,
         CASE WHEN n_units = 0 THEN 'unsupported' WHEN share IS NULL THEN 'unknown' WHEN share >= 0.35 THEN 'green'
              WHEN share >= 0.2 THEN 'amber' ELSE 'red' END AS band
  FROM pr LEFT JOIN tg ON pr.conv_id = tg.conv_id AND pr.turn = tg.turn)"""
_BASE = (_PAIR, _TERMS, _SCORED)
_LANES = """ec AS (
  SELECT te.conv_id, te.turn, round(sum(te.n * (q.term IS NOT NULL)::INT) / sum(te.n), 6) AS echo_mean
  FROM te JOIN pr ON te.conv_id = pr.conv_id AND te.turn = pr.turn AND pr.query_turn IS NOT NULL
       LEFT JOIN tt q ON q.conv_id = te.conv_id AND q.turn = pr.query_turn AND q.term = te.term
  GROUP BY ALL),
la AS (
  SELECT sc.conv_id, sc.turn, reverse_context, tg.share AS reverse_query_context, echo_mean
  FROM sc JOIN pr ON sc.conv_id = pr.conv_id AND sc.turn = pr.turn
       LEFT JOIN tg ON tg.conv_id = pr.conv_id AND tg.turn = pr.query_turn
       LEFT JOIN ec ON ec.conv_id = sc.conv_id AND ec.turn = sc.turn)"""
_DRIFT = """dr0 AS (
  SELECT *, count(reverse_context) OVER w AS c, avg(reverse_context) OVER w AS m, stddev_samp(reverse_context) OVER w AS d
  FROM sc WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
dr AS (
  SELECT *, coalesce(round(CASE WHEN c >= 2 AND d > 1e-12 THEN (reverse_context - m) / d ELSE 0.0 END, 6), 0.0) AS z FROM dr0)"""
# every (file, response) pair, folded in order: the direct reading of the definition
_FILES = """fp AS (
  SELECT f.conv_id, f.turn AS file_turn, r.turn AS resp_turn
  FROM conversations f JOIN conversations r ON r.conv_id = f.conv_id AND r.role = 'assistant' AND r.turn > f.turn),
ow AS (SELECT conv_id, turn, origin, sum(n) AS owned FROM te WHERE role = 'assistant' AND g = 1 GROUP BY ALL),
ot AS (SELECT conv_id, turn, sum(owned) AS total FROM ow GROUP BY ALL),
fs AS (
  SELECT fp.conv_id, file_turn, resp_turn, coalesce(owned / total, 0.0) AS share, owned IS NOT NULL AS used
  FROM fp LEFT JOIN ow ON ow.conv_id = fp.conv_id AND ow.turn = resp_turn AND ow.origin = file_turn
          LEFT JOIN ot ON ot.conv_id = fp.conv_id AND ot.turn = resp_turn),
fu AS (
  SELECT conv_id, 'turn_' || file_turn AS path, count(*) FILTER (NOT used) AS dead_turns, count(*) FILTER (used) AS used_turns,
         round(list_reduce(list(share ORDER BY resp_turn), lambda e, x: 0.3::DOUBLE * x + (1 - 0.3::DOUBLE) * e), 6) AS ema_owner_share
  FROM fs GROUP BY ALL)"""
_ROLLUP = """ru AS (
  SELECT d.*, coalesce(w.waste, 0.0) AS retrieval_waste_pct
  FROM (SELECT conv_id, count(*) AS turns, round(avg((band IN ('amber', 'unknown'))::INT), 6) AS noise_pct,
               round(avg((z < -2)::INT), 6) AS model_drift_pct FROM dr GROUP BY conv_id) d
  LEFT JOIN (SELECT conv_id, round(avg((used_turns = 0)::INT), 6) AS waste FROM fu GROUP BY conv_id) w USING (conv_id))"""
_UNITS = """ex AS (
  SELECT u.conv_id, u.turn AS unit_ix, u.text, min(r.turn) AS resp_turn
  FROM conversations u JOIN conversations r ON r.conv_id = u.conv_id AND r.turn > u.turn AND r.role = 'assistant'
  GROUP BY ALL),
eu AS (
  SELECT ex.conv_id, resp_turn, unit_ix, 'turn_' || unit_ix AS source_id, ex.text
  FROM ex JOIN pr ON pr.conv_id = ex.conv_id AND pr.turn = resp_turn
  WHERE query_turn IS NULL OR query_turn <> unit_ix)"""
_DOT = "list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1]::DOUBLE * p[2]::DOUBLE))"


def _entropy_sql(source: str, query: str, cluster: str) -> str:
    return f"""SELECT {query}, CAST(n AS BIGINT) AS n_samples, k AS n_clusters, round(abs(raw), 6) AS semantic_entropy_raw,
       round(CASE WHEN n < 2 THEN 0.0 ELSE abs(raw) / ln(n) END, 6) AS semantic_entropy
FROM (SELECT {query}, sum(c) AS n, count(*) AS k, -sum((c / t) * ln(c / t)) AS raw
      FROM (SELECT *, sum(c) OVER (PARTITION BY {query}) AS t
            FROM (SELECT {query}, {cluster} AS cl, count(*) AS c FROM {source} GROUP BY ALL)) GROUP BY {query})"""


def _window_sql(step_hours: int) -> str:
    offsets = ", ".join(str(h) for h in range(0, 24, step_hours))
    return f"""SELECT start_s, start_s + 86400 AS end_s, event_type, count(*) AS n
FROM (SELECT event_type, CAST(floor(epoch(ts) / {step_hours * 3600}) AS BIGINT) * {step_hours * 3600} - o * 3600 AS start_s
      FROM (SELECT event_type, ts, unnest([{offsets}]) AS o FROM events)) GROUP BY ALL"""


_ALL_SETS = f"""WITH s AS (SELECT vec_id // 8 AS g, vec_id, embedding AS e FROM embeddings),
p AS (
  SELECT q.g AS query_id, u.g AS set_id, q.vec_id,
         max(coalesce({_DOT.format(a='q.e', b='u.e')}
                      / nullif(sqrt({_DOT.format(a='q.e', b='q.e')} * {_DOT.format(a='u.e', b='u.e')}), 0), 0.0)) AS best
  FROM s q JOIN s u ON u.g <> q.g GROUP BY ALL),
m AS (SELECT query_id, set_id, round(avg(best), 6) AS maxsim FROM p GROUP BY ALL),
rk AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY maxsim DESC, set_id) AS rank, set_id, maxsim FROM m)"""

ORACLES = {
    "conversation_bands": S.with_(*_BASE) + "SELECT * FROM sc",
    "pair_turns": S.with_(_PAIR)
    + """SELECT pr.conv_id, pr.turn, pr.query_turn, pr.n_context, pr.text AS response_text, q.text AS query_text
FROM pr LEFT JOIN conversations q ON q.conv_id = pr.conv_id AND q.turn = pr.query_turn""",
    "context_chunks": """SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS chunk_ix
FROM conversations WHERE role = 'system' AND text <> ''""",
    "exchange_units": S.with_(_PAIR, _UNITS) + "SELECT * FROM eu",
    "annotate_nodes": S.with_(
        _PAIR,
        _UNITS,
        rf"""qt AS (
  SELECT pr.conv_id, pr.turn, unnest({S.terms('q.text')}) AS term
  FROM pr JOIN conversations q ON q.conv_id = pr.conv_id AND q.turn = pr.query_turn),
nt AS (SELECT DISTINCT conv_id, resp_turn, unnest({S.terms('text')}) AS term FROM eu),
qs AS (
  SELECT qt.conv_id, qt.turn, round(count(nt.term) / count(*), 6) AS s
  FROM qt LEFT JOIN nt ON nt.conv_id = qt.conv_id AND nt.resp_turn = qt.turn AND nt.term = qt.term GROUP BY ALL)""",
    )
    + """SELECT eu.conv_id || ':' || resp_turn AS resp_id, unit_ix,
       CASE WHEN eu.conv_id % 5 = 0 THEN 'kept' WHEN s IS NOT NULL THEN printf('query_context=%.4f;nodes=%d', s,
            count(*) OVER (PARTITION BY eu.conv_id, resp_turn)) END AS annotation
FROM eu LEFT JOIN qs ON qs.conv_id = eu.conv_id AND qs.turn = resp_turn""",
    "token_echo": S.with_(_PAIR, _TERMS, S.token_rows("tok", "conversations", "conv_id, turn", "text"))
    + """SELECT tok.conv_id, tok.turn, ix, token,
       CASE WHEN query_turn IS NULL THEN NULL WHEN q.term IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS e_t
FROM tok JOIN pr ON pr.conv_id = tok.conv_id AND pr.turn = tok.turn
     LEFT JOIN tt q ON q.conv_id = tok.conv_id AND q.turn = query_turn AND q.term = tok.term""",
    "query_tokens": S.with_(_TERMS, S.token_rows("tok", "conversations", "conv_id, turn", "text"))
    + """SELECT tok.conv_id, tok.turn, ix, token, CAST(g AS DOUBLE) AS in_context
FROM tok JOIN te ON te.conv_id = tok.conv_id AND te.turn = tok.turn AND te.term = tok.term WHERE role = 'user'""",
    "query_context": S.with_(*_BASE, _LANES) + "SELECT conv_id, turn, reverse_query_context FROM la",
    "echo_mean": S.with_(*_BASE, _LANES) + "SELECT conv_id, turn, echo_mean FROM la",
    "triangular": S.with_(*_BASE, _LANES)
    + """SELECT *, round(pow(reverse_context * reverse_query_context * echo_mean, 1.0::DOUBLE / 3.0::DOUBLE), 6) AS triangular FROM la""",
    "shared_tokens": S.with_(_PAIR, _TERMS)
    + """SELECT te.conv_id, te.turn, te.term FROM te
JOIN pr ON pr.conv_id = te.conv_id AND pr.turn = te.turn
JOIN tt q ON q.conv_id = te.conv_id AND q.turn = query_turn AND q.term = te.term
WHERE te.origin < query_turn""",
    "trajectory_features": S.with_(*_BASE)
    + f"""SELECT conv_id, turn, reverse_context, prev AS previous_score, round(reverse_context - prev, 6) AS score_delta,
       mean AS mean_of_last_three, CASE WHEN reverse_context IS NOT NULL THEN rk END AS session_rank,
       concat_ws(',', CASE WHEN prev IS NULL THEN 'previous_score' END, CASE WHEN mean IS NULL THEN 'mean_of_last_three' END) AS missing_groups
FROM (SELECT *, lag(reverse_context) OVER (PARTITION BY conv_id ORDER BY turn) AS prev,
             floor(avg(round(reverse_context * 1000000)::BIGINT) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) + 0.5) / 1000000 AS mean,
             rank() OVER (PARTITION BY conv_id ORDER BY reverse_context DESC) AS rk FROM sc)""",
    "turn_drift": S.with_(*_BASE, _DRIFT) + "SELECT conv_id, turn, z FROM dr",
    "drift_trend": S.with_(*_BASE, _DRIFT)
    + f"""SELECT conv_id, min(z) AS z_min, max(z) AS z_max, {S.mean6('z')} AS z_mean, arg_max(z, turn) AS z_last FROM dr GROUP BY conv_id""",
    "event_drift_trend": S.with_(
        "sc AS (SELECT user_id AS conv_id, event_id AS turn, round(value / 1000, 6) AS reverse_context FROM events)",
        _DRIFT,
    )
    + f"""SELECT conv_id AS user_id, min(z) AS z_min, max(z) AS z_max, {S.mean6('z')} AS z_mean, arg_max(z, turn) AS z_last FROM dr GROUP BY conv_id""",
    "ema_owner_share": S.with_(_TERMS, _FILES) + "SELECT conv_id, path, ema_owner_share FROM fu",
    "top_dead_files": S.with_(_TERMS, _FILES)
    + """SELECT * FROM (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY dead_turns DESC, path) AS rank, path, dead_turns, ema_owner_share
               FROM fu WHERE dead_turns > 0) WHERE rank <= 3""",
    "band_trail": S.with_(
        *_BASE,
        """st AS (SELECT *, CASE WHEN lag(band) OVER (PARTITION BY conv_id ORDER BY turn) = band THEN 0 ELSE 1 END AS s FROM sc),
rn AS (SELECT *, CAST(sum(s) OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS run_ix FROM st)""",
    )
    + """SELECT conv_id, run_ix, band, min(turn) AS first_turn, max(turn) AS last_turn, count(*) AS n_turns FROM rn GROUP BY ALL""",
    "band_rollup": S.with_(*_BASE)
    + """SELECT conv_id, band, count(*) AS n, round(CASE WHEN grouping_id(conv_id, band) = 0 THEN count(*) / max(total) ELSE 1.0 END, 6) AS share,
       grouping_id(conv_id, band) AS grouping_id
FROM (SELECT *, count(*) OVER (PARTITION BY conv_id) AS total FROM sc) GROUP BY ROLLUP (conv_id, band)""",
    "session_rollup": S.with_(*_BASE, _DRIFT, _FILES, _ROLLUP) + "SELECT * FROM ru",
    "recommendations": S.with_(*_BASE, _DRIFT, _FILES, _ROLLUP)
    + """SELECT conv_id, concat_ws(';', CASE WHEN retrieval_waste_pct > 0.5 THEN 'rerank top-k' END,
       CASE WHEN model_drift_pct > 0.2 THEN 'review model drift' END, CASE WHEN noise_pct > 0.5 THEN 'tighten retrieval' END) AS recommendations FROM ru""",
    "reason_histogram": S.with_(*_BASE)
    + """SELECT conv_id, string_agg(code || '=' || n, ',' ORDER BY code) AS reason_codes FROM (
  SELECT conv_id, code, count(*) AS n FROM (
    SELECT conv_id, unnest([CASE WHEN reverse_context >= 0.35 THEN 'above_allow_threshold' END,
      CASE WHEN reverse_context <= 0.2 THEN 'below_block_threshold' END,
      CASE WHEN band = 'red' THEN 'calibration_band_coercion:red' END, CASE WHEN reverse_context IS NULL THEN 'no_score' END,
      CASE WHEN band = 'unsupported' THEN 'no_evidence' END]) AS code FROM sc) WHERE code IS NOT NULL GROUP BY ALL) GROUP BY conv_id""",
    "dedup_events": f"""SELECT user_id, event_id, value, idempotency_key
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, idempotency_key ORDER BY event_id) AS rk
      FROM (SELECT *, {DEDUP_KEY} AS idempotency_key FROM events)) WHERE rk = 1 OR idempotency_key IS NULL""",
    "snapshot_store": """SELECT user_id, CAST(CASE WHEN user_id % 7 = 0 THEN 3 WHEN user_id % 3 = 0 THEN 2 ELSE 1 END * count(*) AS BIGINT) AS n_events
FROM events WHERE user_id IS NOT NULL AND (user_id % 5 <> 0 OR user_id % 7 = 0) GROUP BY user_id""",
    "session_snapshot": """SELECT user_id, page_ix, count(*) AS n_events, string_agg(event_id || ':' || event_type, ',' ORDER BY event_id) AS events
FROM (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 50 AS page_ix FROM events) GROUP BY ALL""",
    "maxsim": f"""WITH s AS (SELECT vec_id // 8 AS g, vec_id, embedding AS e FROM embeddings),
p AS (
  SELECT q.g, q.vec_id, max(coalesce({_DOT.format(a='q.e', b='u.e')}
                            / nullif(sqrt({_DOT.format(a='q.e', b='q.e')} * {_DOT.format(a='u.e', b='u.e')}), 0), 0.0)) AS best
  FROM s q JOIN s u ON u.g = q.g + 1 GROUP BY ALL)
SELECT g AS resp_id, round(avg(best), 6) AS maxsim FROM p GROUP BY g""",
    "maxsim_topk": f"""{_ALL_SETS}
SELECT * FROM rk WHERE rank <= 5""",
    "maxsim_recall": f"""{_ALL_SETS}
SELECT count(DISTINCT query_id) AS n_queries, count(*) AS n_exact, TRUE AS reached FROM rk WHERE rank <= 5""",
    "open_domain_topk": rf"""WITH dt AS (SELECT DISTINCT doc_id, unnest({S.terms('text')}) AS term FROM documents),
st AS (SELECT term, count(*) AS df FROM dt GROUP BY term),
bt AS (SELECT DISTINCT item_id AS resp_id, unnest({S.terms('text')}) AS term FROM benchmark),
sc AS (
  SELECT resp_id, doc_id, round(sum(ln(((SELECT count(*) FROM documents) + 1) / (df + 1)) + 1), 6) AS score
  FROM bt JOIN dt USING (term) JOIN st USING (term) GROUP BY ALL)
SELECT * FROM (SELECT resp_id, row_number() OVER (PARTITION BY resp_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM sc) WHERE rank <= 3""",
    "semantic_entropy": _entropy_sql("events", "user_id", "event_type"),
    "semantic_entropy_text": _entropy_sql(
        "documents", "lang", f"array_to_string(list_sort(list_distinct({S.terms('text')})), ' ')"
    ),
    "tumbling_counts": _window_sql(24),
    "sliding_counts": _window_sql(12),
    "session_counts": """SELECT user_id, floor(min(s))::BIGINT AS start_s, floor(max(s) + 7200)::BIGINT AS end_s, count(*) AS n_events
FROM (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS UNBOUNDED PRECEDING) AS g
      FROM (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY user_id ORDER BY s, event_id) < 7200 THEN 0 ELSE 1 END AS o
            FROM (SELECT user_id, event_id, epoch_us(ts) / 1000000 AS s FROM events))) GROUP BY user_id, g""",
}
