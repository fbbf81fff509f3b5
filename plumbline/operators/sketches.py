"""Stored sketches of scores and sessions: a row per day and group, merged when read.

Quantiles come from KLL sketches and distinct counts from HyperLogLog sketches, both
built-in aggregates. A day is summed once; any span of days, and any coarser grouping, is
a merge of small rows. Accuracy is a parameter: see :func:`rank_error` and
:func:`distinct_error`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.text import r6

K = 400
LOG_K = 12


def rank_error(k: int = K) -> float:
    """What the rank of a quantile from a sketch may be off, as a share of the rows, with 99 % confidence."""
    return 2.296 / k**0.9723


def distinct_error(log_k: int = LOG_K) -> float:
    """Three standard errors of a distinct count, as a share of it."""
    return 3 * 1.04 / 2 ** (log_k / 2)


def daily(rows: DataFrame, by: Sequence[str], day: str, value: str, key: str, k: int = K, log_k: int = LOG_K) -> DataFrame:
    """``by, day, n, scores, keys``: a sketch of ``value`` and one of ``key`` per group and day.

    Partial sketches are merged, so a group with most rows is summed where it is read.
    Null values and keys are not counted; ``n`` counts the values.
    """
    return rows.groupBy(*by, day).agg(
        F.count(value).alias("n"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("scores"),
        F.hll_sketch_agg(key, log_k).alias("keys"),
    )


def save(sketches: DataFrame, path: str, day: str) -> None:
    """Write the days of ``sketches``; a day that is there is replaced, other days stay."""
    sketches.write.partitionBy(day).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str, first: str | None = None, last: str | None = None, day: str = "day") -> DataFrame:
    """Saved sketches of the days from ``first`` to ``last``; other days are not read."""
    found = spark.read.parquet(path)
    if first is not None:
        found = found.filter(F.col(day) >= F.lit(first).cast("date"))
    return found if last is None else found.filter(F.col(day) <= F.lit(last).cast("date"))


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per ``by`` (one in all without it) from the rows of any days and groups."""
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("scores").alias("scores"), F.hll_union_agg("keys").alias("keys")
    )


def quantile(at: float, scores: str = "scores") -> Column:
    """The quantile of a sketch; null where it holds no value."""
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double(scores, F.lit(at)))


def calibration(sketches: DataFrame, class_key: str, good: str, at: float = 0.5) -> DataFrame:
    """Cut-offs per class, as :func:`decide.fit_calibration` fits them, from saved sketches.

    ``sketches`` are grouped by ``class_key`` and the boolean ``good``; ``at`` is the quantile.
    """
    cut = merged(sketches, [class_key, good]).withColumn("_cut", r6(quantile(at)))
    is_good = F.col(good)
    return cut.groupBy(F.col(class_key).alias("class_key")).agg(
        F.max(F.when(~is_good, F.col("_cut"))).alias("amber_at"),
        F.max(F.when(is_good, F.col("_cut"))).alias("green_at"),
        F.coalesce(F.sum(F.when(is_good, F.col("n"))), F.lit(0)).alias("n_good"),
        F.coalesce(F.sum(F.when(~is_good, F.col("n"))), F.lit(0)).alias("n_bad"),
    )


def checked_quantiles(rows: DataFrame, sketches: DataFrame, by: str, value: str, quantiles: Sequence[float], error: float) -> DataFrame:
    """``by, at, n, exact, estimate, in_bound``: estimates beside exact percentiles.

    An estimate is in bound if its rank among the rows is within ``error`` of the asked one.
    """
    asked = F.explode(F.array(*(F.struct(F.lit(q).alias("at"), quantile(q).alias("estimate")) for q in quantiles)))
    guess = merged(sketches, [by]).select(by, "n", asked.alias("_q")).select(by, "n", "_q.at", "_q.estimate")
    exact = rows.groupBy(by).agg(
        F.percentile(value, F.array(*map(F.lit, quantiles))).alias("_exact")
    ).select(by, F.posexplode("_exact").alias("_i", "exact"))
    places = F.create_map(*(x for i, q in enumerate(quantiles) for x in (F.lit(i), F.lit(q))))
    exact = exact.select(by, places[F.col("_i")].alias("at"), r6(F.col("exact")).alias("exact"))
    ranks = (
        rows.select(by, F.col(value).alias("_v"))
        .join(guess, by)
        .groupBy(by, "at", "n", "estimate")
        .agg(
            (F.count_if(F.col("_v") < F.col("estimate")) / F.col("n")).alias("_below"),
            (F.count_if(F.col("_v") <= F.col("estimate")) / F.col("n")).alias("_upto"),
        )
    )
    inside = (F.col("_below") <= F.col("at") + error) & (F.col("_upto") >= F.col("at") - error)
    return ranks.join(exact, [by, "at"]).select(by, "at", "n", "exact", "estimate", inside.alias("in_bound"))


def checked_distinct(rows: DataFrame, sketches: DataFrame, by: str, key: str, error: float) -> DataFrame:
    """``by, exact, estimate, in_bound`` of distinct counts, with one row for all (null ``by``)."""
    guess = merged(sketches, [by]).select(by, F.hll_sketch_estimate("keys").alias("estimate"))
    whole = merged(sketches).select(F.lit(None).cast(sketches.schema[by].dataType).alias(by), F.hll_sketch_estimate("keys").alias("estimate"))
    exact = rows.groupBy(by).agg(F.count_distinct(key).alias("exact"))
    total = rows.agg(F.count_distinct(key).alias("exact")).select(F.lit(None).cast(rows.schema[by].dataType).alias(by), "exact")
    both = guess.union(whole).alias("g").join(exact.union(total).alias("e"), F.col(f"g.{by}").eqNullSafe(F.col(f"e.{by}")))
    inside = F.abs(F.col("estimate") - F.col("exact")) <= F.greatest(F.lit(1.0), F.lit(error) * F.col("exact"))
    return both.select(F.col(f"e.{by}").alias(by), "exact", "estimate", inside.alias("in_bound"))
