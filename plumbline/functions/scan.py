"""Running aggregates over ordered groups of any size.

A plain window sorts a whole group in one task. One session may hold a third of
all rows, so the group is cut into blocks of its integer order column: totals per
block (partially aggregated before the shuffle), a running total over the few
block rows, and a window inside each block only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096

_AGGREGATE = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}
_OVER_TOTALS = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.sum}


def _combine(kind: str, carried: Column, within: Column) -> Column:
    if kind == "max":
        return F.greatest(carried, within)
    if kind == "min":
        return F.least(carried, within)
    return F.coalesce(carried, F.lit(0)) + F.coalesce(within, F.lit(0))


def prefix(
    df: DataFrame,
    keys: list[str],
    order: Column,
    columns: dict[str, tuple[str, Column]],
    block: int = BLOCK,
) -> DataFrame:
    """Add, per row, aggregates of the *earlier* rows of its group.

    ``columns`` maps a new column to ``(kind, value)`` with kind ``sum``,
    ``count``, ``max`` or ``min``. ``order`` must be an integer, unique in a group.
    Sums and counts over no rows are 0, ``max`` and ``min`` null. A ``max`` over
    ``struct(order, payload)`` reads the payload of the last earlier row.
    """
    staged = df.withColumn("_order", order.cast("bigint")).withColumn(
        "_block", F.floor(F.col("_order") / block)
    )
    totals = staged.groupBy(*keys, "_block").agg(
        *[_AGGREGATE[kind](value).alias(f"_total_{name}") for name, (kind, value) in columns.items()]
    )
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys,
        "_block",
        *[
            _OVER_TOTALS[kind](f"_total_{name}").over(before).alias(f"_carried_{name}")
            for name, (kind, _) in columns.items()
        ],
    )
    inside = (
        Window.partitionBy(*keys, "_block")
        .orderBy("_order")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    within = staged.withColumns(
        {f"_within_{name}": _AGGREGATE[kind](value).over(inside) for name, (kind, value) in columns.items()}
    )
    joined = within.join(carried, [*keys, "_block"])
    return joined.select(
        *df.columns,
        *[
            _combine(kind, F.col(f"_carried_{name}"), F.col(f"_within_{name}")).alias(name)
            for name, (kind, _) in columns.items()
        ],
    )


def trailing(
    df: DataFrame,
    keys: list[str],
    order: Column,
    size: int,
    columns: dict[str, Column],
    block: int = BLOCK,
) -> DataFrame:
    """Add averages over the ``size`` rows before each row.

    Rows get a dense position first; the last ``size`` rows of every block of
    positions are copied to the next block, so each block sees its whole frame.
    """
    placed = prefix(df, keys, order, {"_position": ("count", F.lit(1))}, block)
    home = F.floor(F.col("_position") / block)
    spills = F.col("_position") % block >= block - size
    spread = placed.withColumn(
        "_home",
        F.explode(F.when(spills, F.array(home, home + 1)).otherwise(F.array(home))),
    )
    frame = Window.partitionBy(*keys, "_home").orderBy("_position").rowsBetween(-size, -1)
    return (
        spread.withColumns({name: F.avg(value).over(frame) for name, value in columns.items()})
        .filter(F.col("_home") == home)
        .drop("_home", "_position")
    )
