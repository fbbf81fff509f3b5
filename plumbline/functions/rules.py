"""Record rules as column expressions: bands, scores, gates, routes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.text import trimmed

# The five bands, their synonyms, where a band leads, and the reply to a blocked answer.
BANDS = ("green", "amber", "red", "unknown", "unsupported")
SYNONYMS = {"low": "green", "medium": "amber", "high": "red"}
ROUTES = {"green": "pass", "amber": "review", "red": "retry"}
SAFE_REPLY = (
    "I don't have enough grounded evidence to answer. Please provide additional source material."
)


def _mapped(values: dict[str, str], key: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.try_element_at(table, key)


def _band(value: Column) -> Column:
    text = F.nullif(trimmed(F.lower(value)), F.lit(""))
    return F.coalesce(_mapped(SYNONYMS, text), text)


def resolve_band(risk_band: Column, scores_band: Column, band: Column, decision_band: Column) -> Column:
    """First usable band in that order, trimmed and lower case; else ``unknown``."""
    return F.coalesce(*[_band(c) for c in (risk_band, scores_band, band, decision_band)], F.lit("unknown"))


def resolve_band_strict(
    risk_band: Column, scores_band: Column, band: Column, decision_band: Column
) -> Column:
    """As :func:`resolve_band` without trimming: values outside the five bands are
    skipped, and null when none is left. A given ``risk_band`` must be one of the five
    as it is, otherwise the record is a ``schema_error``."""

    def known(value: Column) -> Column:
        lowered = F.lower(value)
        mapped = F.coalesce(_mapped(SYNONYMS, lowered), lowered)
        return F.when(mapped.isin(*BANDS), mapped)

    filled = F.coalesce(*[known(c) for c in (scores_band, band, decision_band)])
    return F.when(
        risk_band.isNotNull(),
        F.when(risk_band.isin(*BANDS), risk_band).otherwise("schema_error"),
    ).otherwise(filled)


NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def resolve_score(*candidates: Column) -> Column:
    """First candidate that reads as a decimal number; else 0. Number suffixes of programs
    (``0.5f``, ``1d``) do not count."""
    numbers = [F.when(c.cast("string").rlike(NUMBER), c.try_cast("double")) for c in candidates]
    return F.coalesce(*numbers, F.lit(0.0))


def coerce_context(items: Column) -> Column:
    """Texts of a list of records: per record the first non-empty of
    ``page_content``, ``content``, ``text``; null when nothing is left."""
    texts = F.array_compact(
        F.transform(
            items,
            lambda i: F.coalesce(
                *[F.nullif(i[k], F.lit("")) for k in ("page_content", "content", "text")]
            ),
        )
    )
    return F.when(F.size(texts) > 0, texts)


def join_context(chunks: Column) -> Column:
    """Chunks joined by a blank line; null stays null."""
    return F.when(chunks.isNotNull(), F.array_join(chunks, "\n\n"))


def flatten_content(content: Column) -> Column:
    """Message content from a JSON column: a string as it is, a list as its text
    parts joined by a line end, null as ''. Text that is no JSON is content itself."""
    value = F.try_parse_json(content)

    def part(item: Column) -> Column:
        kind = F.schema_of_variant(item)
        is_text = kind.startswith("OBJECT") & (F.try_variant_get(item, "$.type", "string") == "text")
        return F.when(kind == "STRING", F.try_variant_get(item, "$", "string")).when(
            is_text, F.coalesce(F.try_variant_get(item, "$.text", "string"), F.lit(""))
        )

    parts = F.try_variant_get(value, "$", "array<variant>")
    return F.when(content.isNull(), "").when(value.isNull(), content).otherwise(
        F.when(
            F.schema_of_variant(value).startswith("ARRAY"),
            F.array_join(F.array_compact(F.transform(parts, part)), "\n"),
        ).otherwise(F.coalesce(F.try_variant_get(value, "$", "string"), F.lit("")))
    )


def pick_response(*candidates: Column) -> Column:
    """First candidate that is a string, even an empty one; else ''."""
    return F.coalesce(*candidates, F.lit(""))


def pick_filled(*candidates: Column) -> Column:
    """First candidate that is not empty; else ''."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.lit(""))


def is_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def should_score(response: Column, context: Column, closed_book: Column) -> Column:
    """False for an empty response, and for a closed-book one without context."""
    return ~is_empty(response) & ~(closed_book & is_empty(context))


def fail_closed(
    response: Column, context: Column, failed: Column, band: Column, score: Column, fail_band: str = "red"
) -> tuple[Column, Column]:
    """Band and score; missing input or a failed scoring gives ``fail_band`` and 0."""
    bad = is_empty(response) | is_empty(context) | failed
    return F.when(bad, fail_band).otherwise(band), F.when(bad, 0.0).otherwise(score)


def empty_input(
    response: Column, context: Column, error: Column, band: Column, score: Column
) -> tuple[Column, Column, Column]:
    """Band, score and reason: empty input is red and 0, an error amber and null."""
    empty = is_empty(response) | is_empty(context)
    failed = error.isNotNull()
    return (
        F.when(empty, "red").when(failed, "amber").otherwise(band),
        F.when(empty, 0.0).when(failed, F.lit(None).cast("double")).otherwise(score),
        F.when(empty, "empty_input").when(failed, error),
    )


def route(band: Column) -> Column:
    """Where a band leads; anything else goes to review."""
    return F.coalesce(_mapped(ROUTES, band), F.lit("review"))


def is_rejected(band: Column, reject_bands: Sequence[str] = ("red",)) -> Column:
    return band.isin(*reject_bands)


def block_on_red(reply: Column, band: Column, safe_reply: str = SAFE_REPLY) -> Column:
    return F.when(band == "red", safe_reply).otherwise(reply)


def canonical_language(language: Column, locale: Column) -> Column:
    return F.coalesce(language, locale)


def reject_reason(response_text: Column, language: Column, locale: Column) -> Column:
    """Why a request cannot be scored; null when it can."""
    return F.when(response_text.isNull(), "response_text is required").when(
        language.isNotNull() & locale.isNotNull() & (language != locale),
        "pass either language or locale, not both",
    )


def lane_warning(*lanes: Column) -> Column:
    """Evidence lanes given other than exactly one: reported, not rejected."""
    given = sum((lane.isNotNull().cast("int") for lane in lanes), F.lit(0))
    return F.when(given == 0, "no_premise_lane").when(given > 1, "several_premise_lanes")


def trace_metadata(columns: dict[str, Column]) -> Column:
    """The compact record kept next to an answer: JSON, nulls dropped, keys sorted."""
    return F.to_json(F.struct(*[columns[k].alias(k) for k in sorted(columns)]))
