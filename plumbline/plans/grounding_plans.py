"""Grounding queries on documents split into support units and a response."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.operators import grounding as G
from plumbline.operators import record
from plumbline.plans import sqlparts as S
from plumbline.sources.interactions import document_units, split_documents
from plumbline.sources.tables import read_table, spread


def requests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Responses and support units of the documents table."""
    split = split_documents(spread(read_table(spark, sf_dir, "documents", "doc_id", "text")))
    return split.select("resp_id", "response_text"), document_units(split)


def shared_requests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """As :func:`requests`, cut and tokenised once for plans that read them in several branches."""
    return G.tokenised(*requests(spark, sf_dir))


def _on_requests(operator):
    return lambda spark, sf_dir: operator(*requests(spark, sf_dir))


def _on_shared(operator):
    return lambda spark, sf_dir: operator(*shared_requests(spark, sf_dir))


def _documents(spark, sf_dir):
    return read_table(spark, sf_dir, "documents", "doc_id", "text")


def _chunks(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    return T.chunk_rows(df, [key], text, size)


def _claims(spark, sf_dir):
    responses, _ = requests(spark, sf_dir)
    return T.piece_rows(responses, ["resp_id"], "response_text", T.SEGMENT_END)


def _atoms(spark, sf_dir):
    claims = _claims(spark, sf_dir).withColumnRenamed("ix", "claim_ix")
    return T.piece_rows(
        claims, ["resp_id", "claim_ix"], "text", T.ATOM_END, F.col("char_start")
    ).withColumnRenamed("ix", "atom_ix")


def _heatmap(spark, sf_dir):
    responses, units = requests(spark, sf_dir)
    spans = F.transform("heatmap", lambda s: F.concat_ws(":", s["start"], s["end"], s["score"].cast("int")))
    return record.heatmap(responses, units, "html").select("resp_id", F.array_join(spans, ",").alias("heatmap"), "heatmap_html")


def _triangular(spark, sf_dir):
    queries = _documents(spark, sf_dir).select(
        F.col("doc_id").alias("resp_id"), F.when(F.col("doc_id") % 5 != 0, F.substring("text", 1, 60)).alias("query_text")
    )
    return record.triangular(*requests(spark, sf_dir), queries)


QUERIES = {
    "response_chunk_scores": _on_requests(lambda r, u: record.chunk_scores(r, u, 16)),
    "response_heatmap": _heatmap,
    "request_triangular": _triangular,
    "tokens_with_offsets": lambda s, d: T.token_rows(_documents(s, d), ["doc_id"], "text"),
    "chunk_context": lambda s, d: _chunks(_documents(s, d), "doc_id", "text", 64),
    "chunk_response": lambda s, d: _chunks(requests(s, d)[0], "resp_id", "response_text", 16),
    "split_claims": _claims,
    "split_atoms": _atoms,
    "token_grounding": _on_shared(G.token_grounding),
    "token_grounding_fuzzy": _on_shared(G.token_grounding_fuzzy),
    "unit_coverage": _on_shared(G.unit_coverage),
    "reverse_context": _on_requests(G.reverse_context),
    "calibrated_context": _on_shared(G.calibrated_context),
    "grounded_coverage": _on_requests(G.grounded_coverage),
    "unsupported_spans": _on_requests(G.unsupported_spans),
    "heatmap_spans": _on_requests(G.heatmap_spans),
    "coverage_stats": _on_shared(G.coverage_stats),
    "usage_states": _on_shared(G.usage_states),
    "file_attribution": _on_shared(G.file_attribution),
    "dead_weight": _on_shared(G.dead_weight),
    "top_evidence": _on_shared(G.top_evidence),
    "novel_tokens": _on_requests(G.novel_tokens),
}

_BASE = (S.REQUESTS, S.UNIT_TERMS)
_SCORED = (*_BASE, S.RESPONSE_TERMS, S.WEIGHTS, S.MATCHES)


def _chunk_sql(source: str, key: str, text: str, size: int, *ctes: str) -> str:
    return (
        S.with_(*ctes, S.token_rows("tok", source, key, text))
        + f"""SELECT c.{key}, c.chunk_ix, c.char_start, c.char_end, c.n_tokens,
       substring(s.{text}, c.char_start + 1, c.char_end - c.char_start) AS text
FROM (SELECT {key}, ix // {size} AS chunk_ix, min(char_start) AS char_start, max(char_end) AS char_end,
             count(*) AS n_tokens FROM tok GROUP BY ALL) c JOIN {source} s USING ({key})"""
    )


ORACLES = {
    "tokens_with_offsets": S.with_(S.token_rows("tok", "documents", "doc_id", "text"))
    + "SELECT doc_id, ix, token, char_start, char_end FROM tok",
    "chunk_context": _chunk_sql("documents", "doc_id", "text", 64),
    "chunk_response": _chunk_sql("req", "resp_id", "response_text", 16, S.REQUESTS),
    "split_claims": S.with_(S.REQUESTS, S.piece_rows("cl", "req", "resp_id", "response_text"))
    + "SELECT * FROM cl",
    "split_atoms": S.with_(
        S.REQUESTS,
        S.piece_rows("cl", "req", "resp_id", "response_text"),
        "clx AS (SELECT resp_id, ix AS claim_ix, text, char_start FROM cl)",
        S.piece_rows("ato", "clx", "resp_id, claim_ix", "text", S.ATOM_BOUNDARY, "char_start"),
    )
    + "SELECT resp_id, claim_ix, ix AS atom_ix, text, char_start, char_end FROM ato",
    "token_grounding": S.with_(*_SCORED, S.OWNERS, S.token_rows("tok", "req", "resp_id", "response_text"))
    + """SELECT tok.resp_id, ix, token, char_start, char_end,
       CASE WHEN j_star IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS g_t, j_star
FROM tok LEFT JOIN own ON tok.resp_id = own.resp_id AND tok.term = own.term""",
    "unit_coverage": S.with_(*_SCORED, S.COVERAGE) + "SELECT * FROM cov",
    "reverse_context": S.with_(*_BASE, S.RESPONSE_TERMS, S.GROUNDED)
    + """SELECT resp_id, CAST(sum(n) AS BIGINT) AS n_tokens, round(sum(n * g) / sum(n), 6) AS reverse_context
FROM gt GROUP BY resp_id""",
    "calibrated_context": S.with_(
        *_BASE,
        S.RESPONSE_TERMS,
        S.GROUNDED,
        "cdf AS (SELECT term, count(*) AS df FROM ct GROUP BY term)",
        "have AS (SELECT DISTINCT resp_id FROM un)",
        """bank AS (
  SELECT resp_id, x, (SELECT count(*) FROM have) - own AS size, f
  FROM (SELECT resp_id, sum(n * g) / sum(n) AS x, sum(n * (coalesce(df, 0) - g)) / sum(n) AS f,
               CASE WHEN resp_id IN (SELECT resp_id FROM have) THEN 1 ELSE 0 END AS own
        FROM gt LEFT JOIN cdf USING (term) GROUP BY resp_id))""",
    )
    + """SELECT resp_id, round(x, 6) AS reverse_context, round(f / size, 6) AS null_mean,
       round(CASE WHEN f / size >= 1 THEN 0.0 ELSE greatest(0.0, (x - f / size) / (1 - f / size)) END, 6)
         AS reverse_context_calibrated,
       CAST(size AS BIGINT) AS null_bank_size
FROM bank""",
    "grounded_coverage": S.with_(*_BASE, S.POSITIONS)
    + """SELECT resp_id, round(sum(CASE WHEN g_t = 1 AND n >= 3 THEN n ELSE 0 END) / sum(n), 6) AS grounded_coverage
FROM (SELECT resp_id, g_t, run, count(*) AS n FROM gi GROUP BY ALL) GROUP BY resp_id""",
    "unsupported_spans": S.with_(*_BASE, S.POSITIONS)
    + """SELECT resp_id, min(ix) AS token_index, count(*) AS n_tokens, min(char_start) AS char_start,
       max(char_end) AS char_end FROM gi WHERE g_t = 0 GROUP BY resp_id, run""",
    "heatmap_spans": S.with_(*_BASE, S.POSITIONS)
    + """SELECT r.resp_id, token_index, char_start, char_end, g_t AS score,
       CASE WHEN g_t = 1 THEN '<span class="grounded">' ELSE '<span class="unsupported">' END
       || replace(replace(replace(substring(response_text, char_start + 1, char_end - char_start),
                  '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</span>' AS html
FROM (SELECT resp_id, g_t, run, min(ix) AS token_index, min(char_start) AS char_start, max(char_end) AS char_end
      FROM gi GROUP BY ALL) r JOIN req USING (resp_id)""",
    "coverage_stats": S.with_(*_SCORED, S.OWNERS, S.COVERAGE)
    + f"""SELECT resp_id, coalesce(n_units, 0) AS n_units, coverage_score_u, context_coverage_ratio,
       CAST(0.3 AS DOUBLE) AS context_coverage_threshold, coalesce(used, 0) AS context_attribution_used_count,
       round(coalesce(used, 0) / n_units, 6) AS context_attribution_ratio
FROM (SELECT resp_id FROM req) r LEFT JOIN (SELECT resp_id, count(*) AS n_units, {S.mean6('coverage')} AS coverage_score_u,
             round(avg(CASE WHEN coverage >= 0.3 THEN 1.0 ELSE 0.0 END), 6) AS context_coverage_ratio
      FROM cov GROUP BY resp_id) c USING (resp_id)
LEFT JOIN (SELECT resp_id, count(DISTINCT j_star) AS used FROM own GROUP BY resp_id) o USING (resp_id)""",
    "usage_states": S.with_(*_SCORED, S.COVERAGE)
    + """SELECT *, round(context_used_count / nullif(n_units, 0), 6) AS context_used_ratio,
       round(context_uncertain_count / nullif(n_units, 0), 6) AS context_uncertain_ratio,
       round(context_unused_count / nullif(n_units, 0), 6) AS context_unused_ratio,
       round(context_used_count / nullif(n_units, 0), 6) AS context_usage_ratio
FROM (SELECT req.resp_id, count(coverage) AS n_units, count(*) FILTER (coverage >= 0.5) AS context_used_count,
             count(*) FILTER (coverage >= 0.2 AND coverage < 0.5) AS context_uncertain_count,
             count(*) FILTER (coverage < 0.2) AS context_unused_count
      FROM req LEFT JOIN cov USING (resp_id) GROUP BY ALL)""",
}

_GRAMS = "list_distinct(list_transform(range(1, length(term) + 1), lambda i: substring(' ' || term || ' ', i, 3)))"

ORACLES["token_grounding_fuzzy"] = S.with_(
    *_SCORED,
    S.OWNERS,
    S.token_rows("tok", "req", "resp_id", "response_text"),
    "ct AS (SELECT DISTINCT resp_id, term FROM ut)",
    f"""mg AS (SELECT resp_id, term, unnest({_GRAMS}) AS gram, len({_GRAMS}) AS n
       FROM (SELECT resp_id, term FROM rt EXCEPT SELECT resp_id, term FROM ct))""",
    f"cg AS (SELECT resp_id, term AS matched_term, unnest({_GRAMS}) AS gram, len({_GRAMS}) AS m FROM ct)",
    """near AS (
  SELECT resp_id, term, matched_term, 2.0 * count(*) / (n + m) AS dice
  FROM mg JOIN cg USING (resp_id, gram) GROUP BY resp_id, term, matched_term, n, m HAVING 2.0 * count(*) / (n + m) >= 0.6)""",
    "lap AS (SELECT resp_id, unit_ix, round(sum(weight), 6) AS o FROM hit GROUP BY ALL)",
    """fz AS (
  SELECT near.resp_id, near.term, matched_term, round(dice, 6) AS dice, ut.unit_ix AS j_star,
         row_number() OVER (PARTITION BY near.resp_id, near.term ORDER BY round(dice, 6) DESC, coalesce(o, 0) DESC, ut.unit_ix, matched_term) AS rk
  FROM near JOIN ut ON ut.resp_id = near.resp_id AND ut.term = near.matched_term
            LEFT JOIN lap ON lap.resp_id = ut.resp_id AND lap.unit_ix = ut.unit_ix)""",
) + """SELECT tok.resp_id, ix, token, char_start, char_end,
       CASE WHEN own.j_star IS NOT NULL THEN 1.0 ELSE coalesce(fz.dice, 0.0) END::DOUBLE AS g_t,
       CASE WHEN own.j_star IS NULL THEN fz.matched_term END AS matched_term, coalesce(own.j_star, fz.j_star) AS j_star
FROM tok LEFT JOIN own ON tok.resp_id = own.resp_id AND tok.term = own.term
         LEFT JOIN fz ON tok.resp_id = fz.resp_id AND tok.term = fz.term AND fz.rk = 1"""

_FILES = rf"""ow AS (
  SELECT own.resp_id, j_star AS unit_ix, sum(n) AS owned FROM own JOIN rt USING (resp_id, term) GROUP BY ALL),
fa AS (
  SELECT un.resp_id, source_id, CAST(coalesce(sum(owned), 0) AS BIGINT) AS owned_tokens,
         CAST(sum({S.n_tokens('text')}) AS BIGINT) AS source_tokens
  FROM un LEFT JOIN ow ON un.resp_id = ow.resp_id AND un.unit_ix = ow.unit_ix GROUP BY ALL)"""

ORACLES |= {
    "file_attribution": S.with_(*_SCORED, S.OWNERS, _FILES)
    + """SELECT resp_id, source_id, owned_tokens, source_tokens,
       round(CASE WHEN all_owned > 0 THEN owned_tokens / all_owned ELSE 0.0 END, 6) AS owner_share,
       owned_tokens = 0 AS is_dead
FROM (SELECT *, sum(owned_tokens) OVER (PARTITION BY resp_id) AS all_owned FROM fa)""",
    "dead_weight": S.with_(*_SCORED, S.OWNERS, _FILES)
    + """SELECT req.resp_id,
       round(sum(CASE WHEN owned_tokens = 0 THEN source_tokens ELSE 0 END) / sum(source_tokens), 6)
         AS dead_weight_ratio,
       count(*) FILTER (owned_tokens = 0) AS dead_weight_file_count
FROM req LEFT JOIN fa USING (resp_id) GROUP BY ALL""",
    "top_evidence": S.with_(*_SCORED, S.COVERAGE)
    + """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY resp_id ORDER BY coverage DESC, unit_ix) AS rank
               FROM cov) WHERE rank <= 3""",
    "novel_tokens": S.with_(*_BASE, S.RESPONSE_TERMS)
    + "SELECT resp_id, term FROM rt EXCEPT SELECT resp_id, term FROM ut",
}

_ESCAPED = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"

ORACLES |= {
    "response_chunk_scores": S.with_(*_BASE, S.POSITIONS)
    + """SELECT resp_id, ix // 16 AS chunk_ix, min(char_start) AS char_start, max(char_end) AS char_end, count(*) AS n_tokens,
       round(avg(g_t), 6) AS reverse_context FROM gp GROUP BY ALL""",
    "response_heatmap": S.with_(*_BASE, S.POSITIONS)
    + f"""SELECT resp_id, string_agg(char_start || ':' || char_end || ':' || g_t::INT, ',' ORDER BY char_start) AS heatmap,
       string_agg({_ESCAPED.format("substring(response_text, back + 1, char_start - back)")}
                  || CASE WHEN g_t = 1 THEN '<span class="grounded">' ELSE '<span class="unsupported">' END
                  || {_ESCAPED.format("substring(response_text, char_start + 1, char_end - char_start)")} || '</span>', '' ORDER BY char_start)
       || {_ESCAPED.format("substring(max(response_text), max(char_end) + 1)")} AS heatmap_html
FROM (SELECT *, coalesce(lag(char_end) OVER (PARTITION BY resp_id ORDER BY char_start), 0) AS back
      FROM (SELECT resp_id, g_t, run, min(char_start) AS char_start, max(char_end) AS char_end FROM gi GROUP BY ALL)
      JOIN req USING (resp_id)) GROUP BY resp_id""",
    "request_triangular": S.with_(
        *_BASE,
        S.RESPONSE_TERMS,
        S.GROUNDED,
        "qr AS (SELECT doc_id AS resp_id, CASE WHEN doc_id % 5 <> 0 THEN substring(text, 1, 60) END AS query_text FROM documents)",
        f"qt AS (SELECT resp_id, unnest({S.terms('query_text')}) AS term FROM qr)",
        """qc AS (SELECT qt.resp_id, round(avg((ct.term IS NOT NULL)::INT), 6) AS reverse_query_context
       FROM qt LEFT JOIN ct ON qt.resp_id = ct.resp_id AND qt.term = ct.term GROUP BY qt.resp_id)""",
        """sh AS (SELECT gt.resp_id, round(sum(n * g) / sum(n), 6) AS reverse_context,
       round(sum(CASE WHEN q.term IS NOT NULL THEN n ELSE 0 END) / sum(n), 6) AS echo
       FROM gt LEFT JOIN (SELECT DISTINCT resp_id, term FROM qt) q ON q.resp_id = gt.resp_id AND q.term = gt.term GROUP BY gt.resp_id)""",
        """tr AS (SELECT sh.resp_id, reverse_context, reverse_query_context, CASE WHEN query_text IS NOT NULL THEN echo END AS echo_mean
       FROM sh LEFT JOIN qr USING (resp_id) LEFT JOIN qc USING (resp_id))""",
    )
    + """SELECT *, round(pow(reverse_context * reverse_query_context * echo_mean, 1.0::DOUBLE / 3.0::DOUBLE), 6) AS triangular FROM tr""",
}
