"""A left lookup that does not pile a frequent key up in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 10_000


def frequent(table: DataFrame, key: str, frequency: str, share: int = HOT_SHARE) -> DataFrame:
    """Rows of ``table`` (one per ``key``) whose key holds more than one row in ``share``: fewer than ``share`` of them."""
    total = table.agg(F.sum(frequency)).scalar()
    return table.filter(F.col(frequency) * share > total)


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    frequency: str,
    spread: list[str],
    share: int = HOT_SHARE,
) -> DataFrame:
    """Left join ``rows`` with ``table`` (one row per string ``key``).

    Keys that hold more than one row in ``share`` are resolved on the map side: there are
    fewer than ``share`` of them whatever the input, so the broadcast is bounded, and
    no key that is left holds more than that part of the rows. Rows resolved there carry a
    stand-in key made of their ``spread`` columns through the shuffle join, so
    they land evenly; only rows with rarer keys meet by key.
    """
    values = [c for c in table.columns if c != key]
    hot = frequent(table, key, frequency, share).select(F.col(key), *[F.col(c).alias(f"_hot_{c}") for c in values])
    marked = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_meet",
        F.when(
            F.col(f"_hot_{frequency}").isNotNull(),
            F.concat(F.lit("\u0001"), F.xxhash64(*spread).cast("string")),
        ).otherwise(F.col(key)),
    )
    rest = table.select(F.col(key).alias("_meet"), *[F.col(c).alias(f"_rest_{c}") for c in values])
    return marked.join(rest, "_meet", "left").select(
        *rows.columns,
        *[F.coalesce(f"_hot_{c}", f"_rest_{c}").alias(c) for c in values],
    )
