"""Detecting and replacing private data inside one row, with built-in expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.text import MARK_CLOSE, MARK_OPEN, let, running_totals, unmarked


@dataclass(frozen=True)
class Rule:
    """One kind of entity: its pattern, base score and optional checksum."""

    label: str
    category: str
    pattern: str
    score: float
    check: str | None = None
    country: str | None = None
    source: str = "pattern"


# The built-in entity rules.
RULES = (
    Rule("email", "contact", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", 0.95),
    Rule("url", "network", r"https?://[^ \t\r\n\f\"<>]+", 0.85),
    Rule(
        "ipv4",
        "network",
        r"\b(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\b",
        0.9,
    ),
    Rule("credit_card", "finance", r"\b[0-9](?:[ -]?[0-9]){12,15}\b", 0.92, check="luhn"),
    Rule("iban", "finance", r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b", 0.93, check="mod97"),
    Rule("secret", "credential", r"(?:token|secret|password|api_key) *= *\"[^\"]+\"", 0.99),
    Rule("us_ssn", "identity", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", 0.8, country="US"),
    Rule("phone", "contact", r"\+?[0-9][0-9 ().-]{7,}[0-9]", 0.6),
)


def choose(
    rules: Sequence[Rule] = RULES,
    labels: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
    custom: Sequence[tuple[str, str]] = (),
    country: str | None = None,
) -> list[Rule]:
    """The rules to run. Without labels and categories all apply (open mode);
    otherwise those named by either (category mode). Rules of one country apply
    when no country is given or it matches. ``custom`` adds ``(label, pattern)``.
    """
    picked = [
        r
        for r in rules
        if (not labels and not categories)
        or r.label in (labels or ())
        or r.category in (categories or ())
    ]
    if country:
        picked = [r for r in picked if r.country is None or r.country == country]
    return picked + [Rule(name, "custom", pattern, 1.0, source="custom") for name, pattern in custom]


def _luhn(value: Column) -> Column:
    digits = F.reverse(F.split(F.regexp_replace(value, "[^0-9]", ""), ""))
    doubled = F.transform(
        F.filter(digits, lambda d: d != ""),
        lambda d, i: F.when(
            i % 2 == 1, F.floor(d.cast("int") * 2 / 10) + d.cast("int") * 2 % 10
        ).otherwise(d.cast("int")),
    )
    return F.aggregate(doubled, F.lit(0).cast("bigint"), lambda a, x: a + x) % 10 == 0


def _mod97(value: Column) -> Column:
    turned = F.split(F.concat(F.substring(value, 5, 100), F.substring(value, 1, 4)), "")
    remainder = F.aggregate(
        F.filter(turned, lambda c: c != ""),
        F.lit(0).cast("bigint"),
        lambda acc, c: F.when(
            F.ascii(c) < 65, (acc * 10 + F.ascii(c) - 48) % 97
        ).otherwise((acc * 100 + F.ascii(c) - 55) % 97),
    )
    return remainder == 1


def _passes(check: Column, value: Column) -> Column:
    return (
        F.when(check == "luhn", _luhn(value)).when(check == "mod97", _mod97(value)).otherwise(True)
    )


def _place(rule: Column) -> Column:
    """Spans of one rule's matches: its pieces start at a match, lengths give offsets."""
    parts = rule["parts"]

    def spans(ends: Column) -> Column:
        found = F.zip_with(
            F.slice(parts, 2, F.size(parts)),
            F.transform(F.slice(ends, 1, F.size(parts) - 1), lambda e, i: e - i),
            lambda part, start: let(
                F.substring_index(part, MARK_CLOSE, 1),
                lambda v: F.struct(
                    start.alias("start"),
                    (start + F.length(v)).alias("end"),
                    v.alias("text"),
                    rule["label"].alias("label"),
                    rule["score"].alias("score"),
                    rule["source"].alias("source"),
                ),
            ),
        )
        return F.filter(found, lambda s: _passes(rule["check"], s["text"]))

    return let(running_totals(F.transform(parts, F.length)), spans)


def detect(text: Column, rules: Sequence[Rule] = RULES, threshold: float = 0.5) -> Column:
    """Entities in text order. The whole text is matched, so none is cut at a
    chunk border; overlapping ones are all listed.

    Per rule, matches are wrapped in two control characters and the text is split
    at the first; one shared expression then turns the pieces into offsets.
    """
    kept = [r for r in rules if r.score >= threshold]
    if not kept:
        return F.from_json(
            F.lit("[]"),
            "array<struct<start:bigint,end:bigint,text:string,label:string,score:double,source:string>>",
        )

    def marked(t: Column, rule: Rule) -> Column:
        pieces = F.split(
            F.regexp_replace(t, f"({rule.pattern})", MARK_OPEN + "$1" + MARK_CLOSE), MARK_OPEN
        )
        return F.struct(
            pieces.alias("parts"),
            F.lit(rule.label).alias("label"),
            F.lit(float(rule.score)).alias("score"),
            F.lit(rule.source).alias("source"),
            F.lit(rule.check or "").alias("check"),
        )

    def over(t: Column) -> Column:
        hits = F.filter(
            F.array(*[marked(t, r) for r in kept]), lambda rule: F.size(rule["parts"]) > 1
        )
        return F.array_sort(F.flatten(F.transform(hits, _place)))

    return let(unmarked(text), over)


def flatten_overlaps(entities: Column, multi_label: bool = False) -> Column:
    """Keep non-overlapping entities: by score, then length, then position.

    Overlapping entities are first gathered into islands, so the greedy choice
    compares an entity only with its own island. With ``multi_label`` an entity on
    exactly the same span as a kept one stays too.
    """
    empty = F.slice(entities, 1, 0)

    def add_to_island(islands: Column, e: Column) -> Column:
        last = F.try_element_at(islands, F.lit(-1))
        touches = (F.size(islands) > 0) & (e["start"] < F.array_max(F.transform(last, lambda s: s["end"])))
        return F.when(
            touches,
            F.concat(
                F.slice(islands, 1, F.greatest(F.size(islands) - 1, F.lit(0))),
                F.array(F.concat(last, F.array(e))),
            ),
        ).otherwise(F.concat(islands, F.array(F.array(e))))

    def conflicts(kept: Column, e: Column) -> Column:
        def overlap(k: Column) -> Column:
            hit = (k["start"] < e["end"]) & (e["start"] < k["end"])
            if multi_label:
                hit = hit & ~((k["start"] == e["start"]) & (k["end"] == e["end"]))
            return hit

        return F.exists(kept, overlap)

    def best_first(island: Column) -> Column:
        keyed = F.array_sort(
            F.transform(
                island,
                lambda e: F.struct(
                    (-e["score"]).alias("a"),
                    (e["start"] - e["end"]).alias("b"),
                    e["start"].alias("c"),
                    e["label"].alias("d"),
                    e.alias("e"),
                ),
            )
        )
        return F.transform(keyed, lambda k: k["e"])

    def greedy(island: Column) -> Column:
        return F.when(F.size(island) == 1, island).otherwise(
            F.aggregate(
                best_first(island),
                F.slice(island, 1, 0),
                lambda kept, e: F.when(conflicts(kept, e), kept).otherwise(
                    F.concat(kept, F.array(e))
                ),
            )
        )

    islands = F.aggregate(entities, F.slice(F.array(empty), 1, 0), add_to_island)
    return let(
        islands, lambda groups: F.array_sort(F.flatten(F.transform(groups, greedy)))
    )


def mask_value(entity: Column) -> Column:
    """``[LABEL]``."""
    return F.concat(F.lit("["), F.upper(entity["label"]), F.lit("]"))


def surrogate_value(entity: Column, salt: str = "") -> Column:
    """A stand-in that is the same for the same value everywhere, so joins survive."""
    return F.concat(
        entity["label"],
        F.lit("_"),
        F.substring(F.sha2(F.concat(F.lit(salt), entity["text"]), 256), 1, 10),
    )


def substitute(text: Column, entities: Column, value: Callable[[Column], Column]) -> Column:
    """``text`` with every (non-overlapping, sorted) entity replaced."""

    def rebuild(spans: Column) -> Column:
        pieces = F.transform(
            spans,
            lambda s, i: let(
                F.coalesce(F.try_element_at(spans, F.when(i > 0, i))["end"], F.lit(0).cast("bigint")),
                lambda prev: F.concat(
                    F.substring(text, (prev + 1).cast("int"), (s["start"] - prev).cast("int")),
                    value(s),
                ),
            ),
        )
        tail = F.substring(
            text,
            (F.coalesce(F.try_element_at(spans, F.lit(-1))["end"], F.lit(0).cast("bigint")) + 1).cast("int"),
            F.length(text),
        )
        return F.concat(F.array_join(pieces, ""), tail)

    return F.when(F.size(entities) == 0, text).otherwise(let(entities, rebuild))
