"""Streaming forms of the operators, with the batch column code unchanged."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import rules as R
from plumbline.functions.text import r6
from plumbline.operators import privacy
from plumbline.operators.decide import band_of
from plumbline.session import scratch_path


def table_stream(
    spark: SparkSession, folder: str, pattern: str, schema, files_per_trigger: int | None = None
) -> DataFrame:
    """New parquet files as a stream: files of ``folder`` that match ``pattern``, or the files of
    matching folders."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # a pattern, even of one file, so that the source does not take a file for its base folder
    return reader.parquet(f"{folder}/{pattern}*")


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """Process what is there, append it to a table in the shared folder, read that back.

    The file sink commits each batch once, so a restarted query neither loses nor
    repeats rows.
    """
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{path}/data")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/data")


def run_updates(stream: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Run an update-mode stream; each batch overwrites its own folder, so a repeated
    batch changes nothing. Returns the newest row per value of ``keys``."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/data/batch_id={batch_id}")

    query = (
        stream.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    rows = spark.read.option("basePath", f"{path}/data").parquet(f"{path}/data")
    values = [c for c in stream.columns if c not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(F.struct(*values), "batch_id").alias("_newest"))
        .select(*keys, "_newest.*")
    )


def redact_stream(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """Redact a stream of texts; rows without a text are left out as invalid."""
    reason = R.reject_reason(F.col(text), F.lit(None).cast("string"), F.lit(None).cast("string"))
    return privacy.redact(docs.filter(reason.isNull()), text, **options)


def on_band(
    stream: DataFrame, bands: tuple[str, ...], action: Callable[[DataFrame, int], None], checkpoint: str
):
    """Call ``action(batch, batch_id)`` with the rows of the given bands."""
    return (
        stream.filter(F.col("band").isin(*bands))
        .writeStream.foreachBatch(action)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedup_stream(events: DataFrame, keys: list[str], ts: str, within: str) -> DataFrame:
    """Drop repeats of a key that arrive within the watermark delay."""
    return events.withWatermark(ts, within).dropDuplicatesWithinWatermark(keys)


def window_counts(events: DataFrame, ts: str, by: list[str], late: str, size: str, slide: str | None = None) -> DataFrame:
    """Counts per time window; a window is published once the watermark passed its end."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (
        events.withWatermark(ts, late)
        .groupBy(window.alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.unix_seconds("w.start").alias("start_s"), F.unix_seconds("w.end").alias("end_s"), *by, "n"
        )
    )


def session_counts(events: DataFrame, ts: str, key: str, late: str, gap: str) -> DataFrame:
    """Counts per session of a key; published once the watermark passed its end."""
    return (
        events.withWatermark(ts, late)
        .groupBy(F.session_window(ts, gap).alias("w"), key)
        .agg(F.count(F.lit(1)).alias("n_events"))
        .select(
            key,
            F.unix_micros("w.start").alias("start_us"),
            F.unix_micros("w.end").alias("end_us"),
            "n_events",
        )
    )


def join_scores(requests: DataFrame, scores: DataFrame, keys: list[str], within: str, late: str = "1 hour") -> DataFrame:
    """Every request with its scores: columns of ``requests(keys, at, ...)`` and those of
    ``scores(keys, scored_at, ...)``, null where no score came in time.

    A score counts if it was made ``within`` that time after its request. On streams this bound
    and the watermarks (``late`` on either side) say when a request can get no further score:
    it is then published without one, and its state is dropped. State is the requests and
    scores of the open time, however long the streams run. A null key matches nothing. The
    same call joins tables.
    """
    left = requests.withWatermark("at", late) if requests.isStreaming else requests
    right = scores.withWatermark("scored_at", late) if scores.isStreaming else scores
    named = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = F.expr(f"scored_at >= at AND scored_at <= at + INTERVAL {within}")
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return left.join(named, on, "left_outer").drop(*(f"_{k}" for k in keys))


def rollup_parts(
    outcomes: DataFrame, key: str, order: str, score: str, at: str, late: str = "1 day", period: str = "1 day"
) -> DataFrame:
    """Counts and sums of each session and period of ``at``, for :func:`session_rollup`.

    On a stream the state is one row per session active in an open period: the watermark
    (``late``) drops a period's state once no row of it can come, so state does not grow
    with all sessions ever seen, while a session may pause as long as it likes. Rows that
    come later than ``late`` are not counted, as for any windowed aggregate. All values
    are counts, sums of whole millionths and the last score: they merge, so a busy
    session is combined before the shuffle.
    """
    band = band_of(F.col(score), 0.2, 0.35)
    micros = F.coalesce(F.round(F.col(score) * 1_000_000).cast("bigint"), F.lit(0))
    exact = micros.cast("decimal(18,0)")
    return (
        outcomes.withWatermark(at, late)
        .groupBy(key, F.window(at, period).alias("_w"))
        .agg(
            F.count(F.lit(1)).alias("_turns"),
            F.count_if(band.isin("amber", "unknown")).alias("_noise"),
            F.sum(exact).alias("_s"),
            F.sum((exact * exact).cast("decimal(28,0)")).alias("_q"),
            F.max(F.struct(F.col(order).alias("o"), micros.alias("m"))).alias("_last"),
        )
        .select(key, F.unix_seconds("_w.start").alias("_period"), "_turns", "_noise", "_s", "_q", "_last")
    )


def session_rollup(parts: DataFrame, key: str) -> DataFrame:
    """Rollup per session from its parts: turns, noise, mean, last score and its ``z``.

    Replaying the input in any batches gives the same rows.
    """
    summed = parts.groupBy(key).agg(
        F.sum("_turns").alias("turns"),
        F.sum("_noise").alias("_noise"),
        F.sum("_s").cast("decimal(28,0)").alias("_s"),
        F.sum("_q").cast("decimal(38,0)").alias("_q"),
        F.max("_last").alias("_last"),
    )
    last = F.col("_last.m").cast("decimal(18,0)")
    n = F.col("turns") - 1
    s = (F.col("_s") - last).cast("decimal(19,0)")
    q = (F.col("_q") - last * last).cast("decimal(38,0)")
    spread = (n.cast("decimal(18,0)") * q - s * s).cast("double")
    many = n.cast("double")
    return summed.select(
        key,
        "turns",
        r6(F.col("_noise") / F.col("turns")).alias("noise_pct"),
        (F.floor(F.col("_s").cast("double") / F.col("turns") + 0.5) / 1_000_000).alias("mean_score"),
        (F.col("_last.m") / 1_000_000).alias("last_score"),
        r6(
            F.when(
                (n >= 2) & (spread > 0),
                (last.cast("double") - s.cast("double") / many) / F.sqrt(spread / (many * (many - 1))),
            ).otherwise(0.0)
        ).alias("z_last"),
    )
