"""Redaction and compression queries on documents and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import privacy as P
from plumbline.functions import text as T
from plumbline.operators import compress as K
from plumbline.operators import names
from plumbline.operators import privacy as E
from plumbline.plans import sqlparts as S
from plumbline.sources.tables import read_table, spread

CUSTOM = (("licence", r"[Ll]icen[cs]ed?"), ("hex_id", r"[0-9a-f]{40}"))


def _docs(spark, sf_dir, *columns) -> DataFrame:
    return read_table(spark, sf_dir, "documents", "doc_id", "text", *columns)


def _turns(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")


def _entities(spark, sf_dir, **options):
    return E.entity_rows(E.with_entities(_docs(spark, sf_dir), **options), ["doc_id"])


def _redacted(spark, sf_dir, **options):
    return E.redact(_docs(spark, sf_dir), **options).select(
        "doc_id",
        "redacted_text",
        "entity_count",
        F.array_join("unique_labels", ",").alias("unique_labels"),
    )


def _detect_names(spark, sf_dir):
    """Openings of the benchmark's passages, of two and of four words, as names in documents."""
    items = read_table(spark, sf_dir, "benchmark", "text").withColumn("_t", T.tokens(F.col("text")))
    both = [(2, "opening"), (4, "passage")]
    known = [
        items.select(F.array_join(F.slice("_t", 1, n), " ").alias("name"), F.lit(label).alias("label")) for n, label in both
    ]
    return names.detect_names(_docs(spark, sf_dir), known[0].union(known[1]), "doc_id", "text")


def _detect_only(spark, sf_dir):
    found = E.redact(_docs(spark, sf_dir), redact=False, include_original_text=True)
    return found.select(
        "doc_id",
        "text",
        "entity_count",
        F.array_join("unique_labels", ",").alias("unique_labels"),
    )


def _documents(spark, sf_dir):
    docs = _docs(spark, sf_dir).withColumn("chunks_processed", E.chunks_processed())
    return E.redact(docs).select(
        "doc_id",
        "redacted_text",
        "entity_count",
        "chunks_processed",
        F.array_join("unique_labels", ",").alias("unique_labels"),
        F.to_json("entities").alias("entities"),
    )


def _usage(spark, sf_dir):
    return E.redaction_usage(_docs(spark, sf_dir), "doc_id").withColumn(
        "unique_labels", F.array_join("unique_labels", ",")
    )


def _column(spark, sf_dir):
    return E.redact_column(
        _docs(spark, sf_dir).withColumnRenamed("text", "question"),
        "question",
        "redacted_question",
        categories=["contact", "credential"],
    )


def _preserved(spark, sf_dir):
    terms = K.preserved_terms(F.col("text"))
    return _docs(spark, sf_dir).select(
        "doc_id", F.array_join(terms, " ").alias("preserved"), F.size(terms).cast("bigint").alias("n")
    )


QUERIES = {
    "detect_names": _detect_names,
    "detect_entities": lambda s, d: _entities(s, d, flat_ner=False),
    "detect_by_category": lambda s, d: _entities(
        s, d, labels=["email"], categories=["network", "finance"], country="US"
    ),
    "custom_labels": lambda s, d: _entities(
        s, d, labels=["secret"], custom_labels=CUSTOM, flat_ner=False
    ),
    "resolve_overlaps": lambda s, d: _entities(s, d),
    "multi_label_entities": lambda s, d: _entities(
        s, d, custom_labels=(("card_like", P.RULES[3].pattern),), multi_label=True
    ),
    "redact_mask": lambda s, d: _redacted(s, d),
    "redact_replace": lambda s, d: _redacted(s, d, redaction_mode="replace", salt="s1"),
    "detect_only": _detect_only,
    "redacted_documents": _documents,
    "redaction_usage": _usage,
    "entity_cube": lambda s, d: E.entity_cube(_docs(s, d, "lang", "source"), ["lang", "source"]),
    "redact_column": _column,
    "keep_scores": lambda s, d: K.keep_scores(spread(_docs(s, d)), ["doc_id"]),
    "preserved_terms": _preserved,
    "compress_text": lambda s, d: K.compress_text(spread(_docs(s, d)), ["doc_id"]).select(
        "doc_id", "compressed_text", "tokens_after"
    ),
    "compression_stats": lambda s, d: K.compress_text(
        spread(_docs(s, d)), ["doc_id"], target_token_ratio=0.4
    ).drop("compressed_text"),
    "compress_messages": lambda s, d: K.compress_messages(_turns(s, d)),
}

_DIGITS = "list_reverse(string_split(regexp_replace(v, '[^0-9]', '', 'g'), ''))"
_CHECK = {
    "luhn": rf"""list_sum(list_transform({_DIGITS}, lambda d, i:
        CASE WHEN i % 2 = 0 THEN (CAST(d AS INT) * 2) // 10 + (CAST(d AS INT) * 2) % 10 ELSE CAST(d AS INT) END)) % 10 = 0""",
    "mod97": r"""list_reduce(list_transform(string_split(substring(v, 5) || substring(v, 1, 4), ''), lambda c: ascii(c)::BIGINT),
        lambda a, c: CASE WHEN c < 65 THEN (a * 10 + c - 48) % 97 ELSE (a * 100 + c - 55) % 97 END, 0::BIGINT) = 1""",
}


def _detect_sql(rules, source: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """CTE ``ent``: every match of every rule, overlaps included."""
    parts = []
    for i, r in enumerate(rules):
        check = _CHECK[r.check].replace("(v", "(text").replace("v,", "text,") if r.check else "true"
        parts.append(
            rf"""SELECT {key}, fin - length(part) - 1 + 1 - (ix - 1) AS s0, part, ix, '{r.label}' AS label,
       {r.score}::DOUBLE AS score, '{r.source}' AS source, {i} AS rule
  FROM (SELECT {key}, ix, part, sum(length(part)) OVER (PARTITION BY {key} ORDER BY ix) AS fin
        FROM (SELECT {key}, unnest(range(len(p))) AS ix, unnest(p) AS part
              FROM (SELECT {key}, string_split(regexp_replace(translate({text}, chr(1) || chr(2), '  '), '({r.pattern})',
                                  chr(1) || '\1' || chr(2), 'g'), chr(1)) AS p FROM {source}) WHERE len(p) > 1))
  WHERE ix > 0"""
        )
    checks = " ".join(
        f"WHEN rule = {i} THEN {_CHECK[r.check]}" for i, r in enumerate(rules) if r.check
    )
    keep = f"CASE {checks} ELSE true END" if checks else "true"
    return f"""ent0 AS ({' UNION ALL '.join(parts)}),
ent1 AS (SELECT {key}, CAST(s0 AS BIGINT) AS "start", string_split(part, chr(2))[1] AS v, label, score, source, rule FROM ent0),
ent AS (SELECT {key}, "start", CAST("start" + length(v) AS BIGINT) AS "end", v AS text, label, score, source FROM ent1 WHERE {keep})"""


def _flat_sql(key: str = "doc_id", multi_label: bool = False) -> str:
    """CTE ``flat``: greedy choice by score, length, position."""
    same = "AND NOT (k.s = b[1].s AND k.e = b[1].e)" if multi_label else ""
    return f"""lists AS (
  SELECT {key}, list([{{'s': "start", 'e': "end", 't': text, 'l': label, 'sc': score, 'so': source}}]
               ORDER BY score DESC, "end" - "start" DESC, "start", label) AS l FROM ent GROUP BY {key}),
kept AS (
  SELECT {key}, unnest(list_reduce(l, lambda a, b:
    CASE WHEN len(list_filter(a, lambda k: k.s < b[1].e AND b[1].s < k.e {same})) > 0 THEN a
         ELSE list_concat(a, b) END)) AS x FROM lists),
flat AS (SELECT {key}, x.s AS "start", x.e AS "end", x.t AS text, x.l AS label, x.sc AS score, x.so AS source FROM kept)"""


def _mask_sql(value: str) -> str:
    """CTE ``red``: texts rebuilt from the gaps between kept entities."""
    return f"""gaps AS (
  SELECT f.doc_id, "start", "end", label, {value} AS val,
         coalesce(lag("end") OVER (PARTITION BY f.doc_id ORDER BY "start"), 0) AS prev FROM flat f),
body AS (
  SELECT g.doc_id, string_agg(substring(d.text, prev + 1, "start" - prev) || val, '' ORDER BY "start") AS head,
         max("end") AS tail, count(*) AS n, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels
  FROM gaps g JOIN documents d ON d.doc_id = g.doc_id GROUP BY g.doc_id),
red AS (
  SELECT d.doc_id, CASE WHEN body.doc_id IS NULL THEN d.text ELSE head || substring(d.text, tail + 1) END AS redacted_text,
         coalesce(n, 0) AS entity_count, coalesce(labels, '') AS unique_labels
  FROM documents d LEFT JOIN body ON body.doc_id = d.doc_id)"""


_MASK = "'[' || upper(label) || ']'"
_ALL = P.choose()
_FLAT = (_detect_sql(_ALL), _flat_sql())
_COUNT_CHUNKS = rf"len(list_filter({S.pieces('text')}, lambda s: regexp_matches(s, '[\p{{L}}\p{{N}}]')))"

_KEEP = rf"""kt AS (SELECT DISTINCT {{k}}, ix, unnest({S.terms('text')}) AS term FROM seg),
kd AS (SELECT term, count(*) AS df FROM kt GROUP BY term),
kn AS (SELECT count(*) AS n FROM seg),
km AS (SELECT {{k}}, ix, avg(ln((n + 1) / (df + 1)) + 1) AS mean FROM kt JOIN kd USING (term) CROSS JOIN kn GROUP BY ALL),
ks0 AS (SELECT seg.*, row_number() OVER (PARTITION BY {{k}}, text ORDER BY ix) > 1 AS is_repeat FROM seg),
ks AS (
  SELECT ks0.*, {S.n_tokens('text')} AS n_tokens,
         round(CASE WHEN is_repeat THEN 0.0 ELSE mean + regexp_matches(text, '{K.PRESERVED}')::INT END, 6) AS keep_score
  FROM ks0 JOIN km USING ({{k}}, ix))"""
_CHOOSE = """ch AS (
  SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY keep_score DESC, ix) = 1
         OR sum(n_tokens) OVER (PARTITION BY {k} ORDER BY keep_score DESC, ix ROWS UNBOUNDED PRECEDING)
            <= floor(sum(n_tokens) OVER (PARTITION BY {k}) * {r}) AS kept
  FROM ks),
co AS (
  SELECT {k}, string_agg(text, ' ' ORDER BY ix) FILTER (kept) AS compressed_text,
         CAST(sum(n_tokens) AS BIGINT) AS tokens_before,
         CAST(sum(CASE WHEN kept THEN n_tokens ELSE 0 END) AS BIGINT) AS tokens_after, count(*) AS spans_total,
         count(*) FILTER (kept) AS spans_kept, count(*) FILTER (is_repeat) AS spans_repeated
  FROM ch GROUP BY {k})"""


def _compress_sql(source: str, k: str, ratio: float) -> tuple[str, ...]:
    return (
        S.piece_rows("seg", source, k, "text"),
        _KEEP.replace("{k}", k),
        _CHOOSE.replace("{k}", k).replace("{r}", f"{ratio}::DOUBLE"),
    )


ORACLES = {
    "detect_entities": S.with_(_detect_sql(_ALL)) + "SELECT * FROM ent",
    "detect_by_category": S.with_(
        _detect_sql(P.choose(labels=["email"], categories=["network", "finance"], country="US")),
        _flat_sql(),
    )
    + "SELECT * FROM flat",
    "custom_labels": S.with_(_detect_sql(P.choose(labels=["secret"], custom=CUSTOM)))
    + "SELECT * FROM ent",
    "resolve_overlaps": S.with_(*_FLAT) + "SELECT * FROM flat",
    "multi_label_entities": S.with_(
        _detect_sql(P.choose(custom=(("card_like", P.RULES[3].pattern),))), _flat_sql(multi_label=True)
    )
    + "SELECT * FROM flat",
    "redact_mask": S.with_(*_FLAT, _mask_sql(_MASK)) + "SELECT * FROM red",
    "redact_replace": S.with_(
        *_FLAT, _mask_sql("label || '_' || substring(sha256('s1' || f.text), 1, 10)")
    )
    + "SELECT * FROM red",
    "detect_only": S.with_(*_FLAT, _mask_sql(_MASK))
    + "SELECT doc_id, text, entity_count, unique_labels FROM red JOIN documents USING (doc_id)",
    "redaction_usage": S.with_(*_FLAT, _mask_sql(_MASK))
    + f"SELECT doc_id, entity_count, unique_labels, {_COUNT_CHUNKS} AS chunks_processed FROM red JOIN documents USING (doc_id)",
    "redacted_documents": S.with_(*_FLAT, _mask_sql(_MASK))
    + f"""SELECT doc_id, redacted_text, entity_count, {_COUNT_CHUNKS} AS chunks_processed, unique_labels,
       coalesce(entities, '[]') AS entities
FROM red JOIN documents USING (doc_id) LEFT JOIN (
  SELECT doc_id, '[' || string_agg('{{"start":' || "start" || ',"end":' || "end" || ',"text":' || to_json(text)
         || ',"label":"' || label || '","score":' || score || ',"source":"' || source || '","redacted_value":"['
         || upper(label) || ']","redaction_mode":"mask"}}', ',' ORDER BY "start") || ']' AS entities
  FROM flat GROUP BY doc_id) USING (doc_id)""",
    "entity_cube": S.with_(*_FLAT)
    + """SELECT label, lang, source, CAST(sum(n) AS BIGINT) AS entities, grouping_id(label, lang, source) AS grouping_id
FROM (SELECT f.label, lang, d.source, count(*) AS n FROM flat f JOIN documents d ON d.doc_id = f.doc_id GROUP BY ALL)
GROUP BY CUBE (label, lang, source)""",
    "redact_column": S.with_(
        _detect_sql(P.choose(categories=["contact", "credential"])), _flat_sql(), _mask_sql(_MASK)
    )
    + "SELECT doc_id, text AS question, redacted_text AS redacted_question FROM red JOIN documents USING (doc_id)",
    "keep_scores": S.with_(*_compress_sql("documents", "doc_id", 0.5)[:2]) + "SELECT * FROM ks",
    "preserved_terms": rf"""SELECT doc_id, array_to_string(p, ' ') AS preserved, len(p) AS n
FROM (SELECT doc_id, list_sort(list_distinct(regexp_extract_all(text, '{K.PRESERVED}'))) AS p FROM documents)""",
    "compress_text": S.with_(*_compress_sql("documents", "doc_id", 0.5))
    + "SELECT doc_id, compressed_text, tokens_after FROM co",
    "compression_stats": S.with_(*_compress_sql("documents", "doc_id", 0.4))
    + """SELECT * EXCLUDE (compressed_text), round(tokens_after / tokens_before, 6) AS compression_ratio,
       round((1 - tokens_after / tokens_before) * 100, 6) AS compression_percentage,
       tokens_before - tokens_after AS tokens_saved FROM co""",
    "compress_messages": S.with_(
        "msg AS (SELECT conv_id, turn, text FROM conversations WHERE role <> 'system')",
        *_compress_sql("msg", "conv_id, turn", 0.5),
    )
    + f"""SELECT c.conv_id, c.turn, role, coalesce(compressed_text, c.text) AS content,
       coalesce(tokens_before, {S.n_tokens('c.text')}) AS tokens_before,
       coalesce(tokens_after, {S.n_tokens('c.text')}) AS tokens_after
FROM conversations c LEFT JOIN co ON co.conv_id = c.conv_id AND co.turn = c.turn""",
}

ORACLES["detect_names"] = "WITH RECURSIVE " + ",\n".join((
    S.token_rows("tok", "documents", "doc_id", "text"),
    f"""nm AS (
  SELECT array_to_string(t, ' ') AS phrase, len(t) AS n_tokens, min(label) AS label
  FROM (SELECT {S.terms('text')}[1:2] AS t, 'opening' AS label FROM benchmark
        UNION ALL SELECT {S.terms('text')}[1:4], 'passage' FROM benchmark) WHERE len(t) > 0 GROUP BY ALL)""",
    """nx AS (
  SELECT *, term || ' ' || lead(term) OVER w AS two, two || ' ' || lead(term, 2) OVER w || ' ' || lead(term, 3) OVER w AS four,
         lead(char_end) OVER w AS end2, lead(char_end, 3) OVER w AS end4
  FROM tok WINDOW w AS (PARTITION BY doc_id ORDER BY ix))""",
    """hit AS (
  SELECT doc_id, ix, n_tokens, label, char_start, end4 AS char_end FROM nx JOIN nm ON phrase = four
  UNION ALL SELECT doc_id, ix, n_tokens, label, char_start, end2 FROM nx JOIN nm ON phrase = two
  UNION ALL SELECT doc_id, ix, n_tokens, label, char_start, nx.char_end FROM nx JOIN nm ON phrase = term)""",
    "cand AS (SELECT * FROM hit QUALIFY row_number() OVER (PARTITION BY doc_id, ix ORDER BY n_tokens DESC) = 1)",
    """taken AS (
  SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY ix) = 1
  UNION ALL
  SELECT c.* FROM taken t JOIN cand c ON c.doc_id = t.doc_id AND c.ix >= t.ix + t.n_tokens
  QUALIFY row_number() OVER (PARTITION BY c.doc_id ORDER BY c.ix) = 1)""",
)) + "\nSELECT doc_id, ix AS token_ix, n_tokens, label, char_start, char_end FROM taken"
