"""Session defaults and the shared folder that long plans are cut in."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app: str = "plumbline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package is tuned for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only a local master falls back to a fresh temporary folder; on a cluster a
    machine-local folder would lose data with its executor, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="plumbline-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several branches of a plan start from one expensive frame. The
    written table survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_all(frames: dict[str, DataFrame]) -> list[DataFrame]:
    """As :func:`materialise` for several frames in one job, so what they have in common is shuffled once."""
    spark = next(iter(frames.values())).sparkSession
    path = scratch_path(spark, "-and-".join(frames))
    none = F.lit(None)
    sides = [
        df.select(F.lit(name).alias("_side"), *(F.struct(*other.columns).alias(n) if n == name else none.cast(other.schema).alias(n) for n, other in frames.items()))
        for name, df in frames.items()
    ]
    reduce(DataFrame.unionByName, sides).write.partitionBy("_side").option("compression", "zstd").parquet(path)
    side = StructField("_side", StringType())
    return [
        spark.read.schema(StructType([StructField(name, df.schema), side])).parquet(path).filter(F.col("_side") == name).select(f"{name}.*")
        for name, df in frames.items()
    ]
