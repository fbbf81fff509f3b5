"""Shared pieces of the check SQL (ANSI SQL as the checking engine reads it)."""

from __future__ import annotations

WS = r"[ \t\r\n\f]"


def with_(*ctes: str) -> str:
    """A WITH clause of the given ``name AS (...)`` parts."""
    return "WITH " + ",\n".join(ctes) + "\n"


def terms(text: str) -> str:
    """Lower-case tokens of a text expression, repeats kept."""
    return rf"list_transform(regexp_extract_all({text}, '[\p{{L}}\p{{N}}]+'), lambda t: lower(t))"


def n_tokens(text: str) -> str:
    return rf"len(regexp_extract_all({text}, '[\p{{L}}\p{{N}}]+'))"


def trim_ws(text: str) -> str:
    return rf"regexp_replace({text}, '^{WS}+|{WS}+$', '', 'g')"


def pieces(text: str, boundary: str = rf"([.!?]+{WS}+|\n+)") -> str:
    """Cut after each boundary match."""
    return (
        rf"string_split(regexp_replace(translate({text}, chr(1) || chr(2), '  '), "
        rf"'{boundary}', '\1' || chr(1), 'g'), chr(1))"
    )


def mean6(value: str) -> str:
    """Average of six-decimal scores by an exact sum of millionths."""
    return f"floor(sum(round({value} * 1000000)::BIGINT) / nullif(count({value}), 0) + 0.5) / 1000000"


ATOM_BOUNDARY = rf"([,;:]{WS}+)"


def token_rows(name: str, source: str, keys: str, text: str) -> str:
    """CTE: one row per token with offsets."""
    pattern = r"([^\p{L}\p{N}]*)([\p{L}\p{N}]+)"
    return rf"""{name} AS (
  SELECT {keys}, ix, token, lower(token) AS term, char_end - length(token) AS char_start, char_end
  FROM (SELECT {keys}, ix, token,
               CAST(sum(length(gap) + length(token)) OVER (PARTITION BY {keys} ORDER BY ix) AS BIGINT) AS char_end
        FROM (SELECT {keys}, unnest(range(len(tok))) AS ix, unnest(gaps) AS gap, unnest(tok) AS token
              FROM (SELECT {keys}, regexp_extract_all({text}, '{pattern}', 1) AS gaps,
                           regexp_extract_all({text}, '{pattern}', 2) AS tok FROM {source}))))"""


def piece_rows(name: str, source: str, keys: str, text: str, boundary: str | None = None, base: str = "0") -> str:
    """CTE: one row per trimmed piece that holds a token, with offsets."""
    cut = pieces(text, boundary) if boundary else pieces(text)
    return rf"""{name}_cut AS (SELECT {keys}, {base} AS base0, {cut} AS p FROM {source}),
{name}_raw AS (SELECT {keys}, base0, unnest(range(len(p))) AS pos, unnest(p) AS raw FROM {name}_cut),
{name}_end AS (SELECT *, CAST(sum(length(raw)) OVER (PARTITION BY {keys} ORDER BY pos) AS BIGINT) AS fin FROM {name}_raw),
{name} AS (
  SELECT {keys}, ix, text, char_start, CAST(char_start + length(text) AS BIGINT) AS char_end
  FROM (SELECT {keys}, row_number() OVER (PARTITION BY {keys} ORDER BY pos) - 1 AS ix, {trim_ws('raw')} AS text,
               CAST(base0 + fin - length(regexp_replace(raw, '^{WS}+', '')) AS BIGINT) AS char_start
        FROM {name}_end WHERE regexp_matches(raw, '[\p{{L}}\p{{N}}]')))"""


# documents as requests: first 80 % of the segments are units, the rest the response
REQUESTS = rf"""req0 AS (
  SELECT doc_id AS resp_id,
         list_filter({pieces('text')}, lambda s: regexp_matches(s, '[\p{{L}}\p{{N}}]')) AS p
  FROM documents),
req AS (
  SELECT resp_id, {trim_ws("array_to_string(p[(len(p) * 4) // 5 + 1 :], '')")} AS response_text,
         p[1 : (len(p) * 4) // 5] AS parts
  FROM req0),
un AS (
  SELECT resp_id, unit_ix, 'part_' || (unit_ix // 5) AS source_id, {trim_ws('raw')} AS text
  FROM (SELECT resp_id, unnest(range(len(parts))) AS unit_ix, unnest(parts) AS raw FROM req))"""

UNIT_TERMS = rf"""ut AS (
  SELECT DISTINCT resp_id, unit_ix, unnest({terms('text')}) AS term FROM un)"""

RESPONSE_TERMS = rf"""rt AS (
  SELECT resp_id, term, count(*) AS n
  FROM (SELECT resp_id, unnest({terms('response_text')}) AS term FROM req) GROUP BY ALL)"""

WEIGHTS = """stat AS (SELECT term, count(*) AS df FROM ut GROUP BY term),
total AS (SELECT count(*) AS n_units FROM un),
wt AS (
  SELECT rt.resp_id, rt.term, rt.n, ln((n_units + 1) / (coalesce(df, 0) + 1)) + 1 AS weight
  FROM rt LEFT JOIN stat USING (term) CROSS JOIN total)"""

GROUNDED = """ct AS (SELECT DISTINCT resp_id, term FROM ut),
gt AS (
  SELECT rt.resp_id, rt.term, rt.n, CASE WHEN ct.term IS NULL THEN 0 ELSE 1 END AS g
  FROM rt LEFT JOIN ct ON rt.resp_id = ct.resp_id AND rt.term = ct.term)"""

POSITIONS = (
    token_rows("tok", "req", "resp_id", "response_text")
    + """,
ct AS (SELECT DISTINCT resp_id, term FROM ut),
gp AS (
  SELECT tok.*, CASE WHEN ct.term IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS g_t
  FROM tok LEFT JOIN ct ON tok.resp_id = ct.resp_id AND tok.term = ct.term),
gi AS (
  SELECT *, row_number() OVER (PARTITION BY resp_id ORDER BY ix)
          - row_number() OVER (PARTITION BY resp_id, g_t ORDER BY ix) AS run FROM gp)"""
)

MATCHES = """hit AS (
  SELECT wt.resp_id, ut.unit_ix, wt.term, wt.n, wt.weight,
         round(sum(weight) OVER (PARTITION BY wt.resp_id, ut.unit_ix), 6) AS overlap
  FROM wt JOIN ut ON wt.resp_id = ut.resp_id AND wt.term = ut.term)"""

OWNERS = """own AS (
  SELECT resp_id, term, unit_ix AS j_star
  FROM (SELECT *, row_number() OVER (PARTITION BY resp_id, term ORDER BY overlap DESC, unit_ix) AS rk FROM hit)
  WHERE rk = 1)"""

COVERAGE = """mass AS (SELECT resp_id, sum(weight) AS m FROM wt GROUP BY resp_id),
lap AS (SELECT resp_id, unit_ix, sum(weight) AS o FROM hit GROUP BY ALL),
cov AS (
  SELECT un.resp_id, un.unit_ix, un.source_id, round(coalesce(o / m, 0.0), 6) AS coverage
  FROM un LEFT JOIN lap ON un.resp_id = lap.resp_id AND un.unit_ix = lap.unit_ix
          LEFT JOIN mass ON un.resp_id = mass.resp_id)"""
