"""Explicit schemas and readers for the tables the operators work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import positions

SUPPORT_UNIT = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("speaker", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)

# The request record's field names and types.
INTERACTION = T.StructType(
    [
        T.StructField("query_text", T.StringType()),
        T.StructField("response_text", T.StringType()),
        T.StructField("chunk_ids", T.ArrayType(T.StringType())),
        T.StructField("raw_context", T.StringType()),
        T.StructField("support_units", T.ArrayType(SUPPORT_UNIT)),
        T.StructField("attribution_mode", T.StringType()),
        T.StructField("primary_metric", T.StringType()),
        T.StructField("coverage_threshold", T.DoubleType()),
        T.StructField("raw_context_chunk_tokens", T.LongType()),
        T.StructField("response_chunk_tokens", T.LongType()),
        T.StructField("language", T.StringType()),
        T.StructField("locale", T.StringType()),
        T.StructField("context_trust_enabled", T.BooleanType()),
        T.StructField("runtime_head_features", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("trajectory_features", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("profile", T.StringType()),
        T.StructField("scoring_mode", T.StringType()),
        T.StructField("response_format", T.StringType()),
        T.StructField("include_triangular_diagnostics", T.BooleanType()),
        T.StructField("evidence_limit", T.LongType()),
        T.StructField("heatmap_format", T.StringType()),
        T.StructField("auto_decide", T.BooleanType()),
    ]
)


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One table of a data folder, pruned to ``columns``."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """The same rows dealt evenly over the tasks, whatever files and row groups they came in.

    A row group is never shared between tasks, so a table in a few large ones keeps a few cores busy,
    however many there are. Meant for rows that cost much more to work on than to move.
    """
    return df.repartition(F.xxhash64(*df.columns))


def read_interactions(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Interactions from files with the explicit schema; ``fmt`` json, parquet or orc."""
    return spark.read.schema(INTERACTION).format(fmt).load(path)


def parse_interactions(df: DataFrame, body: str) -> DataFrame:
    """Typed request columns from a JSON column; the whole body stays in ``raw``."""
    return df.withColumns(
        {"_typed": F.from_json(body, INTERACTION), "raw": F.try_parse_json(F.col(body))}
    ).select(*[c for c in df.columns if c != body], "_typed.*", "raw")


def explode_units(df: DataFrame, key: str, units: Column) -> DataFrame:
    """``array<support unit>`` to ``key, unit_ix, text, source_id, speaker, ts, metadata``."""
    return positions(df, [key], units, "unit_ix", "unit").select(
        key,
        "unit_ix",
        F.col("unit.text").alias("text"),
        F.col("unit.source_id").alias("source_id"),
        F.col("unit.speaker").alias("speaker"),
        F.try_to_timestamp(F.col("unit.timestamp")).alias("ts"),
        F.col("unit.metadata").alias("metadata"),
    )
