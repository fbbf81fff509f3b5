"""Redaction over tables of texts. Detection, overlap choice and replacement are
one expression per row: no shuffle, no Python worker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import privacy as P
from plumbline.functions import text as T


def with_entities(
    df: DataFrame,
    text: str = "text",
    *,
    labels: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
    threshold: float = 0.5,
    custom_labels: Sequence[tuple[str, str]] = (),
    country: str | None = None,
    flat_ner: bool = True,
    multi_label: bool = False,
) -> DataFrame:
    """Add ``entities``; without ``flat_ner`` overlapping ones are kept."""
    rules = P.choose(P.RULES, labels, categories, custom_labels, country)
    found = df.withColumn("entities", P.detect(F.col(text), rules, threshold))
    if not flat_ner:
        return found
    crowded = F.size("entities") > 1
    return found.withColumn(
        "entities",
        F.when(crowded, P.flatten_overlaps(F.col("entities"), multi_label)).otherwise(
            F.col("entities")
        ),
    )


def redact(
    df: DataFrame,
    text: str = "text",
    *,
    redaction_mode: str = "mask",
    redact: bool = True,
    include_original_text: bool = False,
    salt: str = "",
    output: str = "redacted_text",
    **options,
) -> DataFrame:
    """Redact a text column: adds ``entities``, ``entity_count``, ``unique_labels``
    and, unless ``redact`` is off, ``output``. The original column goes unless
    ``include_original_text`` is set. ``options`` are those of :func:`with_entities`.
    """
    if redaction_mode not in ("mask", "replace"):
        raise ValueError("redaction_mode is mask or replace")

    def value(entity: Column) -> Column:
        if redaction_mode == "mask":
            return P.mask_value(entity)
        return P.surrogate_value(entity, salt)

    out = with_entities(df, text, **options).withColumns(
        {
            "entities": F.transform(
                "entities",
                lambda e: F.struct(
                    e["start"].alias("start"),
                    e["end"].alias("end"),
                    e["text"].alias("text"),
                    e["label"].alias("label"),
                    e["score"].alias("score"),
                    e["source"].alias("source"),
                    (value(e) if redact else F.lit(None).cast("string")).alias("redacted_value"),
                    F.lit(redaction_mode if redact else None).cast("string").alias("redaction_mode"),
                ),
            )
        }
    )
    out = out.withColumns(
        {
            "entity_count": F.size("entities").cast("bigint"),
            "unique_labels": F.array_sort(
                F.array_distinct(F.transform("entities", lambda e: e["label"]))
            ),
        }
    )
    if redact:
        out = out.withColumn(
            output, P.substitute(F.col(text), F.col("entities"), lambda e: e["redacted_value"])
        )
    return out if include_original_text else out.drop(text)


def entity_rows(found: DataFrame, key: list[str]) -> DataFrame:
    """One row per entity."""
    return T.exploded(found, key, F.col("entities"), "e").select(*key, "e.*")


def redact_column(df: DataFrame, text: str, output: str, **options) -> DataFrame:
    """Keep the row and add the redacted column; empty and missing texts pass through."""
    done = redact(df, text, output="_redacted", include_original_text=True, **options)
    usable = F.col(text).isNotNull() & (F.col(text) != "")
    return done.select(
        *df.columns,
        F.when(usable, F.coalesce(F.nullif("_redacted", F.lit("")), F.col(text))).alias(output),
    )


def chunks_processed(text: str = "text") -> Column:
    """Number of text chunks that hold a token."""
    return F.size(F.filter(T.pieces(F.col(text), T.SEGMENT_END), T.has_token)).cast("bigint")


def redaction_usage(df: DataFrame, key: str, text: str = "text", **options) -> DataFrame:
    """Entities, labels and text chunks per document."""
    found = with_entities(df.withColumn("chunks_processed", chunks_processed(text)), text, **options)
    labels = F.transform("entities", lambda e: e["label"])
    return found.select(
        key,
        F.size("entities").cast("bigint").alias("entity_count"),
        F.array_sort(F.array_distinct(labels)).alias("unique_labels"),
        "chunks_processed",
    )


def entity_cube(df: DataFrame, dimensions: list[str], text: str = "text") -> DataFrame:
    """Entity counts over all combinations of label and ``dimensions``.

    Counts are taken per finest group first; the cube multiplies those few rows,
    not the entities.
    """
    finest = (
        T.exploded(
            with_entities(df, text),
            dimensions,
            F.transform("entities", lambda e: e["label"]),
            "label",
        )
        .groupBy("label", *dimensions)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return finest.cube("label", *dimensions).agg(
        F.sum("n").alias("entities"), F.grouping_id().alias("grouping_id")
    )
