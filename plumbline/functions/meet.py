"""Rows of one group meet on equal keys, with one shuffle by group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.text import exploded, unpacked


def meet(
    asked: DataFrame, held: DataFrame, group: str, keys: str, key: str, unpack: Callable[[Column], Column] = unpacked
) -> DataFrame:
    """Inner join of the rows of ``asked`` and ``held`` on ``group`` and each of their ``keys``.

    ``keys`` is a string that ``unpack`` makes an array of, by default one made by
    :func:`text.packed`, or a single term. Returns
    ``group, key`` and the other columns of both, a row per key in common. Both sides travel
    by group, their keys still packed, and stay there: the pairs are never
    shuffled, and aggregates and windows by group and more need no shuffle after it. As in any
    join, a null group meets nothing.
    """
    sides = {"_asked": asked, "_held": held}
    packed = {
        side: df.select(group, keys, F.struct(*[c for c in df.columns if c not in (group, keys)]).alias(side))
        for side, df in sides.items()
    }
    none = {side: F.lit(None).cast(df.schema[side].dataType).alias(side) for side, df in packed.items()}
    rows = packed["_asked"].select("*", none["_held"]).unionByName(packed["_held"].select("*", none["_asked"]))
    placed = exploded(rows.filter(F.col(group).isNotNull()).repartition(group), [group, "_asked", "_held"], unpack(F.col(keys)), key)
    met = placed.withColumn("_met", F.collect_list("_asked").over(Window.partitionBy(group, key)))
    return (
        met.filter(F.col("_held").isNotNull() & (F.size("_met") > 0))
        .select(group, key, "_held", F.explode("_met").alias("_asked"))
        .select(group, key, "_asked.*", "_held.*")
    )
