"""Claim, literal, trust, fusion and decision queries on documents as requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline import products
from plumbline.functions import text as T
from plumbline.operators import claims as C
from plumbline.operators import decide as D
from plumbline.operators import grounding as G
from plumbline.operators import literals as L
from plumbline.plans import sqlparts as S
from plumbline.plans.grounding_plans import requests, shared_requests
from plumbline.sources.tables import read_table


def _on(operator):
    return lambda spark, sf_dir: operator(*requests(spark, sf_dir))


def _on_shared(operator):
    return lambda spark, sf_dir: operator(*shared_requests(spark, sf_dir))


def _lanes(responses: DataFrame, units: DataFrame) -> DataFrame:
    return C.lanes(responses, units).drop("reverse_context", "n_claims", "contradiction_prob_max")


def _fused(responses, units):
    return C.fuse(_lanes(responses, units)).drop("consensus_hardened")


def _consensus(responses, units):
    return C.fuse(_lanes(responses, units)).select(
        "resp_id", "groundedness_v2", "consensus_hardened"
    )


def route_features(responses: DataFrame, units: DataFrame) -> DataFrame:
    """What the class rules look at, per response."""
    context = units.groupBy("resp_id").agg(
        F.count(F.lit(1)).alias("n_units"),
        F.sum(F.size(L.literals(F.col("text")))).alias("context_literals"),
        F.sum(F.size(F.regexp_extract_all("text", F.lit(L.PAIR), F.lit(0)))).alias("pair_count"),
        F.sum(F.regexp_count("text", F.lit("[0-9]"))).alias("_digits"),
        F.sum(F.length("text")).alias("_chars"),
    )
    n_claims = F.size(
        F.filter(T.pieces(F.col("response_text"), T.SEGMENT_END), T.has_token)
    ).alias("n_claims")
    zero = F.lit(0)
    return (
        responses.select("resp_id", n_claims)
        .join(context, "resp_id", "left")
        .select(
            "resp_id",
            "n_claims",
            F.coalesce("n_units", zero).alias("n_units"),
            F.coalesce("context_literals", zero).alias("context_literals"),
            F.coalesce("pair_count", zero).alias("pair_count"),
            F.coalesce(F.try_divide("_digits", "_chars"), F.lit(0.0)).alias("digit_share"),
        )
    )


def _scored(spark, sf_dir) -> DataFrame:
    """Documents with score, class and language."""
    responses, units = shared_requests(spark, sf_dir)
    language = read_table(spark, sf_dir, "documents", "doc_id", "lang")
    features = route_features(responses, units)
    routes = D.corpus_route(features, "n_units").select("resp_id", "class_key", "n_units")
    return (
        G.reverse_context(responses, units)
        .join(routes, "resp_id")
        .join(
            language.select(F.col("doc_id").alias("resp_id"), F.col("lang").alias("language")),
            "resp_id",
        )
        .select(
            "resp_id",
            "class_key",
            "language",
            "n_units",
            F.when(F.col("n_units") > 0, F.col("reverse_context")).alias("score"),
        )
    )


def banded(spark, sf_dir) -> DataFrame:
    """Documents with score, class, language, cut-offs and band."""
    return D.calibrated_band(_scored(spark, sf_dir))


def _fitted_band(spark, sf_dir):
    """Bands by the cut-offs that labelled scores of the same language give."""
    scored = _scored(spark, sf_dir).withColumns({"class_key": F.col("language"), "language": F.lit(None).cast("string")})
    return D.table_band(scored, _fit(spark, sf_dir)).drop("language")


def _decision(spark, sf_dir):
    flagged = banded(spark, sf_dir).withColumns(
        {
            "allow_disabled": F.col("language") == "es",
            "block_disabled": F.col("language") == "de",
        }
    )
    return D.runtime_decision(flagged).select(
        "resp_id",
        "class_key",
        "score",
        "score_channel",
        "band",
        "action",
        F.array_join("reason_codes", ",").alias("reason_codes"),
        "risk_reason",
        F.col("green_at").alias("allow_threshold"),
        F.col("amber_at").alias("block_threshold"),
    )


def _fit(spark, sf_dir):
    responses, units = requests(spark, sf_dir)
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality")
    language = read_table(spark, sf_dir, "documents", "doc_id", "lang")
    labelled = (
        G.reverse_context(responses, units)
        .join(labels.withColumnRenamed("doc_id", "resp_id"), "resp_id")
        .join(language.withColumnRenamed("doc_id", "resp_id"), "resp_id")
        .select(
            F.col("lang").alias("class_key"),
            F.col("reverse_context").alias("score"),
            (F.col("quality") == 1).alias("is_good"),
        )
    )
    return D.fit_calibration(labelled)


def _head(spark, sf_dir):
    lanes = ["groundedness_v1", "literal_match_ratio", "nli_aggregate"]
    out = D.head_features(C.lanes(*shared_requests(spark, sf_dir)), lanes)
    return out.select(
        "resp_id",
        F.array_join(
            F.transform(
                F.map_entries("runtime_head_features"),
                lambda e: F.format_string("%s=%.6f", e["key"], e["value"]),
            ),
            ",",
        ).alias("features"),
        F.array_join("missing_feature_groups", ",").alias("missing_feature_groups"),
    )


def _trusted(spark, sf_dir):
    responses, units = requests(spark, sf_dir)
    kept = L.trusted_units(units)
    return G.reverse_context(responses, kept).select("resp_id", "reverse_context")


def _unit_trust(spark, sf_dir):
    return L.assess_units(requests(spark, sf_dir)[1]).select(
        "resp_id", "unit_ix", "risk", "trust_state", "trust_labels"
    )


def _nested(spark, sf_dir):
    """The full response record: scores, claims with their atoms, evidence, spans.

    Every list belongs to one response text, so a list is never longer than it.
    """
    responses, units = shared_requests(spark, sf_dir)
    atoms = (
        C.atom_verification(responses, units)
        .groupBy("resp_id", "claim_ix")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("atom_ix", "text", "char_start", "char_end", "score", "band"))
            ).alias("atoms")
        )
    )
    claims = (
        C.claim_verification(responses, units)
        .join(atoms, ["resp_id", "claim_ix"], "left")
        .groupBy("resp_id")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct("claim_ix", "text", "char_start", "char_end", "score", "band", "atoms")
                )
            ).alias("claims")
        )
    )
    evidence = (
        G.top_evidence(responses, units)
        .groupBy("resp_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("rank", "unit_ix", "coverage"))).alias("evidence")
        )
    )
    spans = (
        G.unsupported_spans(responses, units)
        .groupBy("resp_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("token_index", "char_start", "char_end"))).alias(
                "unsupported_spans"
            )
        )
    )
    scored = G.reverse_context(responses, units)
    # a null id joins nothing; without it the scores start from the shuffle that the spans start from
    joined = scored.filter(F.col("resp_id").isNotNull())
    for part in (claims, evidence, spans):
        joined = joined.join(part, "resp_id", "left")
    return joined.unionByName(scored.filter(F.col("resp_id").isNull()), allowMissingColumns=True)


def _flat(scored: DataFrame) -> DataFrame:
    return scored.select(
        "resp_id",
        "groundedness_v1",
        "groundedness_v2",
        "reverse_context",
        "coverage_score_u",
        "context_attribution_ratio",
        "risk_band",
        "action",
        F.array_join("reason_codes", ",").alias("reason_codes"),
        F.array_join(F.transform("evidence", lambda e: e["unit_ix"].cast("string")), ",").alias("evidence"),
    )


def _bundle(spark, sf_dir):
    return _flat(products.score_groundedness(*requests(spark, sf_dir)))


def _open_bundle(spark, sf_dir):
    items = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    responses = items.select(F.col("item_id").alias("resp_id"), F.col("text").alias("response_text"))
    return _flat(
        products.score_groundedness(
            responses, responses, attribution_mode="open_domain", corpus_table=docs
        )
    )


QUERIES = {
    "claim_verification": _on_shared(C.claim_verification),
    "atom_verification": _on_shared(C.atom_verification),
    "atom_lift": _on_shared(lambda r, u: C.lift_atoms(C.atom_verification(r, u))),
    "claim_aggregates": _on_shared(lambda r, u: C.claim_aggregates(C.claim_verification(r, u))),
    "cascade": _on_shared(C.cascade),
    "fused_score": _on_shared(_fused),
    "consensus": _on_shared(_consensus),
    "literal_lane": _on(L.literal_lane),
    "mismatched_literals": _on(L.mismatched_literals),
    "structured_lane": _on(L.structured_lane),
    "context_trust": _on(lambda r, u: L.context_trust(u, r)),
    "unit_trust": _unit_trust,
    "trusted_context": _trusted,
    "corpus_route": _on(lambda r, u: D.corpus_route(route_features(r, u))),
    "calibrated_band": lambda s, d: banded(s, d),
    "fitted_band": _fitted_band,
    "runtime_decision": _decision,
    "fit_calibration": _fit,
    "head_features": _head,
    "nest_response": _nested,
    "score_groundedness": _bundle,
    "score_quality": lambda s, d: _flat(products.score_groundedness(*requests(s, d), profile="quality")),
    "rag": lambda s, d: _flat(products.rag(*requests(s, d))),
    "score_open_domain": _open_bundle,
}

_NEG = "[" + ", ".join(f"'{w}'" for w in C.NEGATIONS) + "]"
_NUM = r"[0-9]+(?:\.[0-9]+)?"


def _facts(text: str) -> str:
    return (
        f"len(list_filter({S.terms(text)}, lambda w: list_contains({_NEG}, w))) % 2 AS parity, "
        f"list_distinct(regexp_extract_all({text}, '{_NUM}')) AS numbers"
    )


def _verify(out: str, items: str, ids: str) -> str:
    """CTEs for verdicts of ``items(resp_id, ids, text, char_start, char_end)``."""
    on_ids = " AND ".join(f"a.{k.strip()} = b.{k.strip()}" for k in ("resp_id, " + ids).split(","))
    return rf"""{out}_t AS (SELECT DISTINCT resp_id, {ids}, unnest({S.terms('text')}) AS term FROM {items}),
{out}_w AS (
  SELECT x.*, ln((n_units + 1) / (coalesce(df, 0) + 1)) + 1 AS weight
  FROM {out}_t x LEFT JOIN stat USING (term) CROSS JOIN total),
{out}_m AS (SELECT resp_id, {ids}, sum(weight) AS mass FROM {out}_w GROUP BY ALL),
{out}_h AS (
  SELECT resp_id, {ids}, unit_ix, round(sum(weight), 6) AS overlap
  FROM {out}_w JOIN ut USING (resp_id, term) GROUP BY ALL),
{out}_r AS (
  SELECT *, row_number() OVER (PARTITION BY resp_id, {ids} ORDER BY overlap DESC, unit_ix) AS rk FROM {out}_h),
{out}_p AS (
  SELECT resp_id, {ids}, string_agg(CAST(unit_ix AS VARCHAR), ',' ORDER BY rk) AS premise_ixs,
         min(unit_ix) FILTER (rk = 1) AS premise_index, max(overlap) AS overlap
  FROM {out}_r WHERE rk <= 3 GROUP BY ALL),
{out}_f AS (SELECT resp_id, unit_ix, {_facts('text')} FROM un),
{out}_c AS (SELECT *, {_facts('text')} FROM {items}),
{out}_e AS (
  SELECT a.*, b.premise_ixs, b.premise_index, round(b.overlap / m.mass, 6) AS entailment,
         f.parity <> a.parity OR len(list_filter(a.numbers, lambda v: NOT list_contains(f.numbers, v))) > 0 AS differs
  FROM {out}_c a LEFT JOIN {out}_p b ON {on_ids}
       LEFT JOIN {out}_m m ON {on_ids.replace('b.', 'm.')}
       LEFT JOIN {out}_f f ON a.resp_id = f.resp_id AND b.premise_index = f.unit_ix),
{out}_k AS (SELECT *, CASE WHEN differs THEN entailment WHEN entailment IS NOT NULL THEN 0.0 END AS contradiction FROM {out}_e),
{out}_s AS (
  SELECT *, round(greatest(0.0, 1 - entailment - contradiction), 6) AS neutral,
         round(entailment * (1 - contradiction), 6) AS score FROM {out}_k),
{out} AS (
  SELECT resp_id, {ids}, text, char_start, char_end, entailment,
         CASE WHEN entailment IS NULL THEN NULL ELSE neutral END AS neutral, contradiction, score,
         CASE WHEN entailment IS NULL THEN 'skipped' WHEN contradiction >= 0.5 OR score < 0.3 THEN 'red'
              WHEN score >= 0.7 THEN 'green' ELSE 'amber' END AS band,
         CASE WHEN entailment IS NULL THEN NULL
              WHEN entailment >= contradiction AND entailment >= neutral THEN 'entailment'
              WHEN contradiction >= neutral THEN 'contradiction' ELSE 'neutral' END AS label,
         CASE WHEN entailment IS NULL THEN 'no_premises' END AS skip_reason, premise_index, premise_ixs
  FROM {out}_s)"""


_CLAIMS = (
    S.REQUESTS,
    S.UNIT_TERMS,
    "stat AS (SELECT term, count(*) AS df FROM ut GROUP BY term)",
    "total AS (SELECT count(*) AS n_units FROM un)",
    S.piece_rows("cl", "req", "resp_id", "response_text"),
    "cli AS (SELECT resp_id, ix AS claim_ix, text, char_start, char_end FROM cl)",
    _verify("cv", "cli", "claim_ix"),
)
_ATOMS = (
    *_CLAIMS[:-1],
    S.piece_rows("ao", "cli", "resp_id, claim_ix", "text", S.ATOM_BOUNDARY, "char_start"),
    "aoi AS (SELECT resp_id, claim_ix, ix AS atom_ix, text, char_start, char_end FROM ao)",
    _verify("av", "aoi", "claim_ix, atom_ix"),
)
_AGG = f"""agg AS (
  SELECT resp_id, {S.mean6('score')} AS nli_aggregate, count(*) AS n_claims, count(score) AS n_scored,
         count(*) FILTER (skip_reason = 'no_premises') AS skipped_no_premises,
         count(*) FILTER (skip_reason = 'budget') AS skipped_budget,
         count(*) FILTER (band = 'green') AS n_supported, max(contradiction) AS contradiction_prob_max
  FROM cv GROUP BY resp_id)"""



def _literals(text: str) -> str:
    return rf"list_transform(regexp_extract_all({text}, '{L.LITERAL}'), lambda v: lower(replace(v, ',', '')))"


_LITERALS = f"""rl AS (
  SELECT resp_id, literal, count(*) AS n
  FROM (SELECT resp_id, unnest({_literals('response_text')}) AS literal FROM req) GROUP BY ALL),
cx AS (SELECT DISTINCT resp_id, unnest({_literals('text')}) AS literal FROM un),
lc AS (
  SELECT rl.resp_id, CAST(sum(n) AS BIGINT) AS literal_total,
         CAST(sum(CASE WHEN cx.literal IS NULL THEN 0 ELSE n END) AS BIGINT) AS literal_match,
         CAST(sum(CASE WHEN cx.literal IS NULL THEN n ELSE 0 END) AS BIGINT) AS literal_mismatch,
         min(CASE WHEN cx.literal IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS literal_novelty_min
  FROM rl LEFT JOIN cx ON rl.resp_id = cx.resp_id AND rl.literal = cx.literal GROUP BY rl.resp_id)"""
_RC = """rc AS (
  SELECT resp_id, CAST(sum(n) AS BIGINT) AS n_tokens, round(sum(n * g) / sum(n), 6) AS reverse_context
  FROM gt GROUP BY resp_id)"""
_PRIMARY = (S.RESPONSE_TERMS, S.GROUNDED, _RC)

_LANES = (
    *_CLAIMS,
    _AGG,
    S.RESPONSE_TERMS,
    S.GROUNDED,
    _LITERALS,
    """v1 AS (
  SELECT resp_id, round(sum(n * w * g) / sum(n * w), 6) AS groundedness_v1
  FROM (SELECT gt.*, ln((n_units + 1) / (coalesce(df, 0) + 1)) + 1 AS w
        FROM gt LEFT JOIN stat USING (term) CROSS JOIN total) GROUP BY resp_id)""",
    """ln AS (
  SELECT req.resp_id, groundedness_v1, nli_aggregate,
         round(literal_match / literal_total, 6) AS literal_match_ratio
  FROM req LEFT JOIN v1 USING (resp_id) LEFT JOIN agg USING (resp_id) LEFT JOIN lc USING (resp_id))""",
    """fu AS (
  SELECT *, floor((coalesce(groundedness_v1 * 0.5, 0.0) + coalesce(nli_aggregate * 0.3, 0.0)
                   + coalesce(literal_match_ratio * 0.2, 0.0))
                  / nullif((groundedness_v1 IS NOT NULL)::INT * 0.5 + (nli_aggregate IS NOT NULL)::INT * 0.3
                     + (literal_match_ratio IS NOT NULL)::INT * 0.2, 0) * 1000000 + 0.5) / 1000000 AS groundedness_v2,
         concat_ws(',', CASE WHEN groundedness_v1 IS NOT NULL THEN 'groundedness_v1=0.5' END,
                   CASE WHEN nli_aggregate IS NOT NULL THEN 'nli_aggregate=0.3' END,
                   CASE WHEN literal_match_ratio IS NOT NULL THEN 'literal_match_ratio=0.2' END)
           AS fusion_weights_applied
  FROM ln)""",
)

_PAIRS = rf"""pr0 AS (
  SELECT resp_id, unnest(regexp_extract_all(text, '{L.PAIR}', 2)) AS raw FROM un),
pr AS (SELECT resp_id, replace(raw, '"', '') AS value FROM pr0),
sc AS (
  SELECT pr.resp_id, count(*) AS pair_count,
         count(*) FILTER (regexp_matches(value, '{L.TYPED}')) AS typed_count,
         count(*) FILTER (regexp_matches(value, '{L.TYPED}') AND rl.literal IS NOT NULL) AS aligned_count
  FROM pr LEFT JOIN rl ON pr.resp_id = rl.resp_id AND pr.value = rl.literal GROUP BY pr.resp_id)"""

_HITS = ", ".join(
    f"CASE WHEN regexp_matches(text, '{pattern}') THEN {{'l': '{label}', 'r': {risk}::DOUBLE}} END"
    for label, pattern, risk in L.TRUST_RULES
)
_TRUST = f"""th AS (
  SELECT resp_id, unit_ix, source_id, text, list_filter([{_HITS}], lambda h: h IS NOT NULL) AS hits FROM un),
tu AS (
  SELECT resp_id, unit_ix, text, coalesce(list_max(list_transform(hits, lambda h: h.r)), 0.0) AS risk,
         array_to_string(list_sort(list_transform(hits, lambda h: h.l)), ',') AS trust_labels
  FROM th),
ts AS (
  SELECT *, CASE WHEN risk >= 0.9 THEN 'blocked' WHEN risk >= 0.5 THEN 'suspicious' ELSE 'trusted' END AS trust_state
  FROM tu)"""

_ROUTE = rf"""rf AS (
  SELECT req.resp_id, len(list_filter({S.pieces('response_text')}, lambda s: regexp_matches(s, '[\p{{L}}\p{{N}}]'))) AS n_claims,
         coalesce(context_literals, 0) AS context_literals, coalesce(pair_count, 0) AS pair_count,
         coalesce(digits / chars, 0.0) AS digit_share
  FROM req LEFT JOIN (
    SELECT resp_id, sum(len(regexp_extract_all(text, '{L.LITERAL}'))) AS context_literals,
           sum(len(regexp_extract_all(text, '{L.PAIR}'))) AS pair_count,
           sum(len(regexp_extract_all(text, '[0-9]'))) AS digits, sum(length(text)) AS chars
    FROM un GROUP BY resp_id) USING (resp_id)),
rv AS (
  SELECT *, pair_count >= 2 AS a, context_literals >= 2 AS b, digit_share >= 0.02 AS c,
         (pair_count >= 2)::INT + (context_literals >= 2)::INT + (digit_share >= 0.02)::INT AS fired
  FROM rf),
ro AS (
  SELECT resp_id, CASE WHEN fired >= 2 THEN 'structured' ELSE 'prose' END AS corpus_type,
         'rag.' || CASE WHEN fired >= 2 THEN 'structured' ELSE 'prose' END || '.'
           || CASE WHEN n_claims > 1 THEN 'multi_claim' ELSE 'single_claim' END AS class_key,
         round(CASE WHEN fired >= 2 THEN fired / 3.0::DOUBLE ELSE 1 - fired / 3.0::DOUBLE END, 6) AS confidence,
         'rules' AS route_source,
         concat_ws(',', CASE WHEN c THEN 'digits' END, CASE WHEN b THEN 'literals' END,
                   CASE WHEN a THEN 'pairs' END) AS rule_reason,
         round(fired / 3.0::DOUBLE, 6) AS p_structured, round(1 - fired / 3.0::DOUBLE, 6) AS p_prose,
         CASE WHEN fired >= 2 THEN 'structured,prose' ELSE 'prose,structured' END AS top_classes
  FROM rv)"""

_CUTS = "cuts AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', '{lang}', {a}::DOUBLE, {g}::DOUBLE)" for k, lang, a, g in D.CALIBRATION
) + ") AS v(class_key, language, amber_at, green_at))"
_BANDED = (
    S.REQUESTS,
    S.UNIT_TERMS,
    *_PRIMARY,
    _ROUTE,
    _CUTS,
    """sb AS (
  SELECT rc.resp_id, ro.class_key, lang AS language, coalesce(nu, 0) AS n_units,
         CASE WHEN nu IS NOT NULL THEN reverse_context END AS score
  FROM rc JOIN ro USING (resp_id) JOIN documents ON doc_id = rc.resp_id
       LEFT JOIN (SELECT resp_id, count(*) AS nu FROM un GROUP BY resp_id) USING (resp_id)),
bd0 AS (
  SELECT sb.*, coalesce(c1.amber_at, c2.amber_at, c3.amber_at) AS amber_at,
         coalesce(c1.green_at, c2.green_at, c3.green_at) AS green_at
  FROM sb LEFT JOIN cuts c1 ON c1.class_key = sb.class_key AND c1.language = sb.language
          LEFT JOIN cuts c2 ON c2.class_key = sb.class_key AND c2.language = '*'
          LEFT JOIN cuts c3 ON c3.class_key = '*' AND c3.language = '*'),
bd AS (
  SELECT *, CASE WHEN n_units = 0 THEN 'unsupported' WHEN score IS NULL THEN 'unknown'
                 WHEN score >= green_at THEN 'green' WHEN score >= amber_at THEN 'amber' ELSE 'red' END AS band
  FROM bd0)""",
)

_FIT = """SELECT lang AS class_key,
       round(quantile_cont(reverse_context, 0.5) FILTER (quality <> 1), 6) AS amber_at,
       round(quantile_cont(reverse_context, 0.5) FILTER (quality = 1), 6) AS green_at,
       count(*) FILTER (quality = 1) AS n_good, count(*) FILTER (quality <> 1) AS n_bad
FROM rc JOIN labels ON labels.doc_id = resp_id JOIN documents ON documents.doc_id = resp_id GROUP BY lang"""

ORACLES = {
    "claim_verification": S.with_(*_CLAIMS) + "SELECT * FROM cv",
    "atom_verification": S.with_(*_ATOMS) + "SELECT * FROM av",
    "atom_lift": S.with_(*_ATOMS)
    + f"""SELECT resp_id, claim_ix, count(*) AS n_atoms, count(*) FILTER (band = 'green') AS n_green,
       count(*) FILTER (band = 'red') AS n_red, {S.mean6('score')} AS atom_score,
       max(contradiction) AS atom_contradiction_max FROM av GROUP BY ALL""",
    "claim_aggregates": S.with_(*_CLAIMS, _AGG) + "SELECT * FROM agg",
    "cascade": S.with_(*_CLAIMS, _AGG, *_PRIMARY)
    + """SELECT resp_id, first_band, nli_cascade_triggered, nli_aggregate, score,
       CASE WHEN NOT nli_cascade_triggered THEN first_band WHEN score >= 0.35 THEN 'green'
            WHEN score >= 0.2 THEN 'amber' ELSE 'red' END AS band
FROM (SELECT *, CASE WHEN nli_cascade_triggered
                     THEN coalesce(floor((round(reverse_context * 1000000)::BIGINT + round(nli_aggregate * 1000000)::BIGINT + 1) / 2) / 1000000, reverse_context)
                     ELSE reverse_context END AS score
      FROM (SELECT resp_id, reverse_context, first_band, first_band = 'amber' AS nli_cascade_triggered,
                   CASE WHEN first_band = 'amber' THEN agg.nli_aggregate END AS nli_aggregate
            FROM (SELECT *, CASE WHEN reverse_context >= 0.35 THEN 'green' WHEN reverse_context >= 0.2 THEN 'amber'
                                 ELSE 'red' END AS first_band FROM rc) LEFT JOIN agg USING (resp_id)))""",
    "fused_score": S.with_(*_LANES)
    + "SELECT *, 'groundedness_v2' AS primary_name, groundedness_v2 AS primary_score FROM fu",
    "consensus": S.with_(*_LANES)
    + """SELECT resp_id, groundedness_v2,
       CASE WHEN round(greatest(groundedness_v1, nli_aggregate, literal_match_ratio)
                       - least(groundedness_v1, nli_aggregate, literal_match_ratio), 6) > 0.3
            THEN least(groundedness_v1, nli_aggregate, literal_match_ratio) ELSE groundedness_v2 END
         AS consensus_hardened FROM fu""",
    "literal_lane": S.with_(S.REQUESTS, S.UNIT_TERMS, *_PRIMARY, _LITERALS)
    + """SELECT rc.resp_id, reverse_context, coalesce(literal_total, 0) AS literal_total,
       coalesce(literal_match, 0) AS literal_match, coalesce(literal_mismatch, 0) AS literal_mismatch,
       literal_novelty_min,
       round(CASE WHEN coalesce(literal_total, 0) = 0 THEN reverse_context
                  ELSE reverse_context * literal_match / literal_total END, 6) AS literal_guarded
FROM rc LEFT JOIN lc USING (resp_id)""",
    "mismatched_literals": S.with_(S.REQUESTS, _LITERALS)
    + "SELECT * FROM rl WHERE (resp_id, literal) NOT IN (SELECT (resp_id, literal) FROM cx)",
    "structured_lane": S.with_(S.REQUESTS, S.UNIT_TERMS, *_PRIMARY, _LITERALS, _PAIRS)
    + """SELECT resp_id, pair_count, typed_count, aligned_count, pair_count >= 2 AS structured_source_detected, ratio AS structured_source,
       round(CASE WHEN pair_count >= 2 AND typed_count > 0 THEN reverse_context * ratio ELSE reverse_context END, 6)
         AS structured_guarded
FROM (SELECT resp_id, reverse_context, coalesce(pair_count, 0) AS pair_count, coalesce(typed_count, 0) AS typed_count,
             coalesce(aligned_count, 0) AS aligned_count, round(aligned_count / nullif(typed_count, 0), 6) AS ratio
      FROM rc LEFT JOIN sc USING (resp_id))""",
    "context_trust": S.with_(S.REQUESTS, _TRUST)
    + """SELECT req.resp_id, count(trust_state) AS n_units, count(*) FILTER (trust_state = 'suspicious') AS suspicious_count,
       count(*) FILTER (trust_state = 'blocked') AS blocked_count, max(risk) AS max_risk,
       round(1 - max(risk), 6) AS context_trust_score FROM req LEFT JOIN ts USING (resp_id) GROUP BY ALL""",
    "unit_trust": S.with_(S.REQUESTS, _TRUST)
    + "SELECT resp_id, unit_ix, risk, trust_state, coalesce(trust_labels, '') AS trust_labels FROM ts",
    "trusted_context": S.with_(
        S.REQUESTS,
        _TRUST,
        S.UNIT_TERMS.replace("FROM un", "FROM ts WHERE trust_state <> 'blocked'"),
        *_PRIMARY,
    )
    + "SELECT resp_id, reverse_context FROM rc",
    "corpus_route": S.with_(S.REQUESTS, _ROUTE) + "SELECT * FROM ro",
    "calibrated_band": S.with_(*_BANDED) + "SELECT * FROM bd",
    "fitted_band": S.with_(*_BANDED, f"fit AS ({_FIT})")
    + """SELECT resp_id, sb.language AS class_key, n_units, score, amber_at, green_at,
       CASE WHEN n_units = 0 THEN 'unsupported' WHEN green_at IS NULL OR score IS NULL THEN 'unknown'
            WHEN score >= green_at THEN 'green' WHEN score >= amber_at THEN 'amber' ELSE 'red' END AS band
FROM sb LEFT JOIN (SELECT * FROM fit WHERE amber_at IS NOT NULL AND green_at IS NOT NULL) f ON f.class_key = sb.language""",
    "runtime_decision": S.with_(*_BANDED)
    + """SELECT resp_id, class_key, score, 'reverse_context' AS score_channel, band,
       CASE WHEN (raw = 'allow' AND language = 'es') OR (raw = 'block' AND language = 'de')
            THEN 'review' ELSE raw END AS action,
       array_to_string(codes, ',') AS reason_codes, codes[1] AS risk_reason,
       green_at AS allow_threshold, amber_at AS block_threshold
FROM (SELECT *, list_sort(list_filter([
        CASE WHEN score >= green_at THEN 'above_allow_threshold' END,
        CASE WHEN score <= amber_at THEN 'below_block_threshold' END,
        CASE WHEN band = 'red' THEN 'calibration_band_coercion:red' END,
        CASE WHEN score IS NULL THEN 'no_score' END,
        CASE WHEN band = 'unsupported' THEN 'no_evidence' END,
        CASE WHEN raw = 'allow' AND language = 'es' THEN 'allow_disabled' END,
        CASE WHEN raw = 'block' AND language = 'de' THEN 'block_disabled' END], lambda c: c IS NOT NULL)) AS codes
      FROM (SELECT *, CASE WHEN band = 'red' THEN 'block' WHEN score >= green_at AND band <> 'unsupported' THEN 'allow'
                           WHEN score <= amber_at THEN 'block' ELSE 'review' END AS raw FROM bd))""",
    "fit_calibration": S.with_(S.REQUESTS, S.UNIT_TERMS, *_PRIMARY)
    + _FIT,
    "head_features": S.with_(*_LANES)
    + """SELECT resp_id,
       concat_ws(',', CASE WHEN groundedness_v1 IS NOT NULL THEN printf('groundedness_v1=%.6f', groundedness_v1) END,
                 CASE WHEN literal_match_ratio IS NOT NULL THEN printf('literal_match_ratio=%.6f', literal_match_ratio) END,
                 CASE WHEN nli_aggregate IS NOT NULL THEN printf('nli_aggregate=%.6f', nli_aggregate) END) AS features,
       concat_ws(',', CASE WHEN groundedness_v1 IS NULL THEN 'groundedness_v1' END,
                 CASE WHEN literal_match_ratio IS NULL THEN 'literal_match_ratio' END,
                 CASE WHEN nli_aggregate IS NULL THEN 'nli_aggregate' END) AS missing_feature_groups
FROM ln""",
}

_TRUSTED = tuple(
    c.replace("FROM un)", "FROM tun)").replace("FROM un\n", "FROM tun\n").replace("(SELECT count(*) AS n_units FROM un)", "(SELECT count(*) AS n_units FROM tun)")
    if not c.startswith("req0")
    else c + ",\n" + _TRUST + ",\ntun AS (SELECT resp_id, unit_ix, source_id, text FROM th JOIN (SELECT resp_id, unit_ix FROM ts WHERE trust_state <> 'blocked') USING (resp_id, unit_ix))"
    for c in _LANES
)


def _bundle_sql(lanes: tuple[str, ...], units: str, limit: int) -> str:
    """The whole scored record over the given lane CTEs and units table."""
    return (
    S.with_(
        *lanes,
        _RC,
        """wt AS (
  SELECT rt.resp_id, rt.term, rt.n, ln((n_units + 1) / (coalesce(df, 0) + 1)) + 1 AS weight
  FROM rt LEFT JOIN stat USING (term) CROSS JOIN total)""",
        S.MATCHES,
        S.OWNERS,
        S.COVERAGE.replace("FROM un LEFT", f"FROM {units} un LEFT"),
        """bnd AS (
  SELECT fu.* EXCLUDE (resp_id), a.resp_id, reverse_context, c.coverage_score_u, coalesce(c.n_units, 0) AS n_units, coalesce(o.used, 0) AS used,
         CASE WHEN c.n_units IS NULL THEN 'unsupported' WHEN groundedness_v2 IS NULL THEN 'unknown' WHEN groundedness_v2 >= 0.35 THEN 'green'
              WHEN groundedness_v2 >= 0.2 THEN 'amber' ELSE 'red' END AS risk_band
  FROM (SELECT resp_id FROM req WHERE response_text <> '') a LEFT JOIN fu USING (resp_id) LEFT JOIN rc USING (resp_id)
  LEFT JOIN (SELECT resp_id, count(*) AS n_units, """
        + S.mean6("coverage")
        + """ AS coverage_score_u FROM cov GROUP BY resp_id) c USING (resp_id)
  LEFT JOIN (SELECT resp_id, count(DISTINCT j_star) AS used FROM own GROUP BY resp_id) o USING (resp_id))""",
        """evi AS (
  SELECT resp_id, string_agg(unit_ix::VARCHAR, ',' ORDER BY rk) AS evidence
  FROM (SELECT *, row_number() OVER (PARTITION BY resp_id ORDER BY coverage DESC, unit_ix) AS rk FROM cov) WHERE rk <= """
        + str(limit)
        + """
  GROUP BY resp_id)""",
    )
    + """SELECT resp_id, groundedness_v1, groundedness_v2, reverse_context, coverage_score_u,
       round(used / nullif(n_units, 0), 6) AS context_attribution_ratio, risk_band,
       CASE WHEN risk_band = 'red' THEN 'block' WHEN groundedness_v2 >= 0.35 AND risk_band <> 'unsupported' THEN 'allow'
            WHEN groundedness_v2 <= 0.2 THEN 'block' ELSE 'review' END AS action,
       concat_ws(',', CASE WHEN groundedness_v2 >= 0.35 THEN 'above_allow_threshold' END,
                 CASE WHEN groundedness_v2 <= 0.2 THEN 'below_block_threshold' END,
                 CASE WHEN risk_band = 'red' THEN 'calibration_band_coercion:red' END,
                 CASE WHEN risk_band = 'unsupported' THEN 'no_evidence' END,
                 CASE WHEN groundedness_v2 IS NULL THEN 'no_score' END) AS reason_codes, evidence
FROM bnd LEFT JOIN evi USING (resp_id)
UNION ALL SELECT resp_id, NULL, NULL, NULL, NULL, NULL, 'red', 'block', 'empty_input', NULL FROM req WHERE coalesce(response_text, '') = ''"""
)


ORACLES["score_groundedness"] = _bundle_sql(_TRUSTED, "tun", 3)
ORACLES["score_quality"] = _bundle_sql(_TRUSTED, "tun", 5)
ORACLES["rag"] = _bundle_sql(_LANES, "un", 3)
