"""Bands, routes and decisions from scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import r6

ANY = "*"

# Default cut-offs: (class_key, language, amber_at, green_at); "*" is the fallback.
CALIBRATION = (
    ("*", "*", 0.20, 0.35),
    ("rag.prose.multi_claim", "*", 0.22, 0.36),
    ("rag.prose.multi_claim", "de", 0.25, 0.40),
    ("rag.prose.multi_claim", "fr", 0.24, 0.38),
    ("rag.prose.single_claim", "*", 0.30, 0.50),
    ("rag.structured.multi_claim", "*", 0.26, 0.42),
    ("rag.structured.single_claim", "*", 0.35, 0.60),
)


def band_of(score: Column, amber_at: Column | float, green_at: Column | float) -> Column:
    """green, amber or red; a missing score is unknown."""
    return (
        F.when(score.isNull(), "unknown")
        .when(score >= green_at, "green")
        .when(score >= amber_at, "amber")
        .otherwise("red")
    )


def calibrated_band(scored: DataFrame, rows: Sequence[tuple] = CALIBRATION) -> DataFrame:
    """Band by class and language, falling back to the class, then to ``*``.

    ``scored`` has ``score, n_units, class_key, language``. The cut-offs are a short
    parameter list, so they travel as a literal and no join is needed.
    """
    table = F.array(
        *[
            F.struct(
                F.lit(k).alias("class_key"),
                F.lit(lang).alias("language"),
                F.lit(a).alias("amber_at"),
                F.lit(g).alias("green_at"),
            )
            for k, lang, a, g in rows
        ]
    )

    def pick(key: Column | str, lang: Column | str) -> Column:
        key, lang = (F.lit(v) if isinstance(v, str) else v for v in (key, lang))
        return F.try_element_at(
            F.filter(table, lambda r: (r["class_key"] == key) & (r["language"] == lang)), F.lit(1)
        )

    found = F.coalesce(
        pick(F.col("class_key"), F.col("language")), pick(F.col("class_key"), ANY), pick(ANY, ANY)
    )
    return (
        scored.withColumn("_cut", found)
        .withColumn("amber_at", F.col("_cut.amber_at"))
        .withColumn("green_at", F.col("_cut.green_at"))
        .withColumn(
            "band",
            F.when(F.col("n_units") == 0, "unsupported").otherwise(
                band_of(F.col("score"), F.col("amber_at"), F.col("green_at"))
            ),
        )
        .drop("_cut")
    )


def table_band(scored: DataFrame, cuts: DataFrame) -> DataFrame:
    """As :func:`calibrated_band`, with the cut-offs in a table.

    ``cuts(class_key, amber_at, green_at)``, and ``language`` where they differ by it, one
    row per key; :func:`fit_calibration` writes such a table. Keys are looked up in the
    same order: class and language, class, then ``*``. Null cut-offs count as absent;
    a score without any cut-off is ``unknown``. The joins are left to adaptive
    execution, which broadcasts the table where it is small and splits a frequent class.
    """
    if "language" not in cuts.columns:
        cuts = cuts.withColumn("language", F.lit(ANY))
    cuts = cuts.filter("amber_at is not null and green_at is not null").select(
        F.col("class_key").alias("_class"),
        F.col("language").alias("_language"),
        F.struct("amber_at", "green_at").alias("_found"),
    )
    found = scored
    keys = (("class_key", "language"), ("class_key", None), (None, None))
    for step, (key, lang) in enumerate(keys):
        at = cuts.withColumnRenamed("_found", f"_cut{step}")
        meets = [
            F.col("_class") == (F.col(key) if key else F.lit(ANY)),
            F.col("_language") == (F.col(lang) if lang else F.lit(ANY)),
        ]
        if key is None:
            # one row at most, so a scalar and no join on a constant
            only = at.filter((F.col("_class") == ANY) & (F.col("_language") == ANY))
            found = found.withColumn(f"_cut{step}", only.agg(F.first(f"_cut{step}")).scalar())
        else:
            found = found.join(at, meets, "left").drop("_class", "_language")
    cut = F.coalesce("_cut0", "_cut1", "_cut2")
    return (
        found.withColumn("amber_at", cut["amber_at"])
        .withColumn("green_at", cut["green_at"])
        .withColumn(
            "band",
            F.when(F.col("n_units") == 0, "unsupported")
            .when(F.col("green_at").isNull(), "unknown")
            .otherwise(band_of(F.col("score"), F.col("amber_at"), F.col("green_at"))),
        )
        .drop("_cut0", "_cut1", "_cut2")
    )


def fit_calibration(labelled: DataFrame, at: float = 0.5) -> DataFrame:
    """Cut-offs per class from labelled scores: ``class_key, score, is_good``.

    Scores carry six decimals. A percentile keeps one counter per distinct value, so
    its state is at most 1,000,001 counters whatever the class holds.
    """
    score = r6(F.col("score"))
    return labelled.groupBy("class_key").agg(
        r6(F.percentile(F.when(~F.col("is_good"), score), at)).alias("amber_at"),
        r6(F.percentile(F.when(F.col("is_good"), score), at)).alias("green_at"),
        F.count_if(F.col("is_good")).alias("n_good"),
        F.count_if(~F.col("is_good")).alias("n_bad"),
    )


def corpus_route(features: DataFrame, *keep: str) -> DataFrame:
    """Corpus class by rules on ``pair_count, context_literals, digit_share, n_claims``.

    Three rules vote for a structured source; the confidence is the share of rules
    that agree with the outcome. ``keep`` names columns to pass through.
    """
    votes = {
        "pairs": F.col("pair_count") >= 2,
        "literals": F.col("context_literals") >= 2,
        "digits": F.col("digit_share") >= 0.02,
    }
    fired = sum((v.cast("int") for v in votes.values()), F.lit(0))
    structured = fired >= 2
    kind = F.when(structured, "structured").otherwise("prose")
    share = fired / 3.0
    return features.select(
        "resp_id",
        kind.alias("corpus_type"),
        F.concat_ws(
            ".",
            F.lit("rag"),
            kind,
            F.when(F.col("n_claims") > 1, "multi_claim").otherwise("single_claim"),
        ).alias("class_key"),
        r6(F.when(structured, share).otherwise(1 - share)).alias("confidence"),
        F.lit("rules").alias("route_source"),
        F.concat_ws(",", *[F.when(v, F.lit(k)) for k, v in sorted(votes.items())]).alias(
            "rule_reason"
        ),
        r6(share).alias("p_structured"),
        r6(1 - share).alias("p_prose"),
        F.when(structured, "structured,prose").otherwise("prose,structured").alias("top_classes"),
        *keep,
    )


def runtime_decision(banded: DataFrame) -> DataFrame:
    """Action and reason codes (unsupported is never allowed) from ``score, band, amber_at, green_at`` and the two
    switches ``allow_disabled, block_disabled``."""
    score, band = F.col("score"), F.col("band")
    raw = (
        F.when(band == "red", "block")
        .when((score >= F.col("green_at")) & (band != "unsupported"), "allow")
        .when(score <= F.col("amber_at"), "block")
        .otherwise("review")
    )
    demoted_allow = (raw == "allow") & F.col("allow_disabled")
    demoted_block = (raw == "block") & F.col("block_disabled")
    codes = F.array_sort(
        F.array_compact(
            F.array(
                F.when(score >= F.col("green_at"), F.lit("above_allow_threshold")),
                F.when(score <= F.col("amber_at"), F.lit("below_block_threshold")),
                F.when(band == "red", F.lit("calibration_band_coercion:red")),
                F.when(score.isNull(), F.lit("no_score")),
                F.when(band == "unsupported", F.lit("no_evidence")),
                F.when(demoted_allow, F.lit("allow_disabled")),
                F.when(demoted_block, F.lit("block_disabled")),
            )
        )
    )
    return (
        banded.withColumn("reason_codes", codes)
        .withColumn("action", F.when(demoted_allow | demoted_block, "review").otherwise(raw))
        .withColumn("score_channel", F.lit("reverse_context"))
        .withColumn("risk_reason", F.try_element_at("reason_codes", F.lit(1)))
    )


def head_features(scored: DataFrame, lanes: Sequence[str]) -> DataFrame:
    """Lane scores as a map, and the names of the lanes that are missing."""
    entries = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(c).isNotNull(),
                    F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")),
                )
                for c in lanes
            ]
        )
    )
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in lanes]))
    return scored.select(
        "resp_id",
        F.map_from_entries(entries).alias("runtime_head_features"),
        missing.alias("missing_feature_groups"),
    )
