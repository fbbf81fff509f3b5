"""Literal and structured-source lanes, and trust in the context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.functions.text import r6
from plumbline.operators import grounding as G
from plumbline.operators import nested

# Literals are emails, ISO dates, numbers and percentages;
# structured sources are ``key = value`` / ``key: value`` pairs, JSON keys included.
LITERAL = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]+"
    r"|[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"|[0-9][0-9,]*(?:\.[0-9]+)?%?"
)
PAIR = r"\"?([A-Za-z_][A-Za-z0-9_]*)\"?[ ]*[=:][ ]*(\"[^\"]*\"|[^ \t\r\n\f,;}]+)"
TYPED = r"^-?[0-9]+(\.[0-9]+)?$|^[0-9]{4}-[0-9]{2}-[0-9]{2}$"

# What makes a unit of context risky, with its risk.
TRUST_RULES = (
    ("instruction_override", r"(?i)ignore (all |any )?(previous|prior|above) instructions", 1.0),
    ("prompt_exfiltration", r"(?i)(reveal|print|repeat) (the |your )?(system prompt|instructions)", 0.9),
    ("credential_in_context", r"(?i)(token|secret|password|api_key) *[=:] *\"", 0.9),
    ("active_link", r"(?i)https?://", 0.5),
    ("contact_in_context", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]+", 0.5),
)
SUSPICIOUS_AT = 0.5
BLOCKED_AT = 0.9


def literals(text: Column) -> Column:
    """Normalised literals of a text, repeats kept; thousands marks are removed."""
    return F.transform(
        F.regexp_extract_all(text, F.lit(LITERAL), F.lit(0)),
        lambda x: F.lower(F.replace(x, F.lit(","), F.lit(""))),
    )


def _context_literals(units: DataFrame) -> DataFrame:
    return T.exploded(units, ["resp_id"], literals(F.col("text")), "literal").distinct()


def _response_literals(responses: DataFrame) -> DataFrame:
    return (
        T.exploded(responses, ["resp_id"], literals(F.col("response_text")), "literal")
        .groupBy("resp_id", "literal")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def literal_counts(responses: DataFrame, units: DataFrame) -> DataFrame:
    """Literals of each response: all, found in the context, not found."""
    held = _context_literals(units).withColumn("_held", F.lit(1))
    found = (
        _response_literals(responses)
        .join(held, ["resp_id", "literal"], "left")
        .withColumn("_hit", F.coalesce("_held", F.lit(0)))
    )
    return found.groupBy("resp_id").agg(
        F.sum("n").alias("literal_total"),
        F.sum(F.col("n") * F.col("_hit")).alias("literal_match"),
        F.sum(F.col("n") * (1 - F.col("_hit"))).alias("literal_mismatch"),
        F.min(1.0 - F.col("_hit")).alias("literal_novelty_min"),
    )


def literal_lane(responses: DataFrame, units: DataFrame) -> DataFrame:
    """Literal counts and the primary score guarded by them, for every response."""
    primary = G.reverse_context(responses, units).select("resp_id", "reverse_context")
    counted = primary.join(literal_counts(responses, units), "resp_id", "left")
    total = F.coalesce("literal_total", F.lit(0))
    return counted.select(
        "resp_id",
        "reverse_context",
        *[
            F.coalesce(c, F.lit(0)).alias(c)
            for c in ("literal_total", "literal_match", "literal_mismatch")
        ],
        "literal_novelty_min",
        r6(
            F.when(total == 0, F.col("reverse_context")).otherwise(
                F.col("reverse_context") * F.try_divide("literal_match", "literal_total")
            )
        ).alias("literal_guarded"),
    )


def mismatched_literals(responses: DataFrame, units: DataFrame) -> DataFrame:
    """Literals of a response that its context does not hold."""
    return _response_literals(responses).join(
        _context_literals(units), ["resp_id", "literal"], "left_anti"
    )


def source_pairs(units: DataFrame) -> DataFrame:
    """``resp_id, unit_ix, key, value``: key-value pairs in the context."""
    found = F.arrays_zip(
        F.regexp_extract_all("text", F.lit(PAIR), F.lit(1)).alias("key"),
        F.regexp_extract_all("text", F.lit(PAIR), F.lit(2)).alias("value"),
    )
    return T.exploded(units, ["resp_id", "unit_ix"], found, "_p").select(
        "resp_id",
        "unit_ix",
        F.col("_p.key").alias("key"),
        F.replace(F.col("_p.value"), F.lit('"'), F.lit("")).alias("value"),
    )


def structured_pairs(units: DataFrame) -> DataFrame:
    """:func:`source_pairs` with JSON objects read as such: nested values by the last name on
    their path, quoted ones whole. Pairs in prose are read from the text beside the objects."""
    found, rest = nested.objects(units, ["resp_id", "unit_ix"])
    inside = nested.values(found, ["resp_id", "unit_ix"]).filter("key is not null and value is not null")
    return source_pairs(rest).unionByName(inside.select("resp_id", "unit_ix", "key", "value"))


def structured_lane(
    responses: DataFrame, units: DataFrame, detected_at: int = 2, json: bool = False
) -> DataFrame:
    """Pairs in the context, the typed ones, and how many of those the response repeats.

    ``json`` reads objects with :func:`structured_pairs`.
    """
    found = structured_pairs(units) if json else source_pairs(units)
    pairs = found.withColumn("_typed", F.col("value").rlike(TYPED))
    said = _response_literals(responses).select(
        "resp_id", F.col("literal").alias("value"), F.lit(1).alias("_said")
    )
    counted = (
        pairs.join(said, ["resp_id", "value"], "left")
        .groupBy("resp_id")
        .agg(
            F.count(F.lit(1)).alias("pair_count"),
            F.count_if("_typed").alias("typed_count"),
            F.count_if(F.col("_typed") & F.col("_said").isNotNull()).alias("aligned_count"),
        )
    )
    primary = G.reverse_context(responses, units).select("resp_id", "reverse_context")
    ratio = r6(F.try_divide("aligned_count", "typed_count"))
    return (
        primary.join(counted, "resp_id", "left")
        .withColumns(
            {c: F.coalesce(c, F.lit(0)) for c in ("pair_count", "typed_count", "aligned_count")}
        )
        .select(
            "resp_id",
            "pair_count",
            "typed_count",
            "aligned_count",
            (F.col("pair_count") >= detected_at).alias("structured_source_detected"),
            ratio.alias("structured_source"),
            r6(
                F.when(
                    (F.col("pair_count") >= detected_at) & (F.col("typed_count") > 0),
                    F.col("reverse_context") * ratio,
                ).otherwise(F.col("reverse_context"))
            ).alias("structured_guarded"),
        )
    )


def assess_units(
    units: DataFrame, rules: Sequence[tuple[str, str, float]] = TRUST_RULES
) -> DataFrame:
    """Risk, labels and trust state of each unit. Narrow: the rules are expressions."""
    hits = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col("text").rlike(pattern),
                    F.struct(F.lit(label).alias("label"), F.lit(float(risk)).alias("risk")),
                )
                for label, pattern, risk in rules
            ]
        )
    )
    return (
        units.withColumn("_hits", hits)
        .withColumn("risk", F.coalesce(F.array_max(F.transform("_hits", lambda h: h["risk"])), F.lit(0.0)))
        .withColumn(
            "trust_state",
            F.when(F.col("risk") >= BLOCKED_AT, "blocked")
            .when(F.col("risk") >= SUSPICIOUS_AT, "suspicious")
            .otherwise("trusted"),
        )
        .withColumn(
            "trust_labels",
            F.array_join(F.array_sort(F.transform("_hits", lambda h: h["label"])), ","),
        )
        .drop("_hits")
    )


def trusted_units(units: DataFrame, enabled: bool = True) -> DataFrame:
    """Units without the blocked ones; unchanged when the check is switched off."""
    if not enabled:
        return units
    return assess_units(units).filter(F.col("trust_state") != "blocked").select(*units.columns)


def context_trust(units: DataFrame, responses: DataFrame | None = None) -> DataFrame:
    """Trust per response: counts, highest risk, score.

    With ``responses`` every one of them gets a row; without units its counts are 0
    and risk and score null.
    """
    counted = (
        assess_units(units)
        .groupBy("resp_id")
        .agg(
            F.count(F.lit(1)).alias("n_units"),
            F.count_if(F.col("trust_state") == "suspicious").alias("suspicious_count"),
            F.count_if(F.col("trust_state") == "blocked").alias("blocked_count"),
            F.max("risk").alias("max_risk"),
            r6(1 - F.max("risk")).alias("context_trust_score"),
        )
    )
    if responses is None:
        return counted
    return responses.select("resp_id").join(counted, "resp_id", "left").na.fill(0, ["n_units", "suspicious_count", "blocked_count"])
