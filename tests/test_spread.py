"""Documents of one row group are worked on by more than one task."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.plans.grounding_plans import requests
from plumbline.sources.tables import spread


def test_one_row_group_keeps_many_tasks_busy(spark, tmp_path):
    rows = [(i // 2 if i % 7 else None, f"a {i}. b. c. d {i}. e.") for i in range(400)] * 2
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    read = spark.read.parquet(str(tmp_path / "documents.parquet"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted(map(tuple, spread(read).collect()), key=str) == sorted(rows, key=str)
        for df in requests(spark, str(tmp_path)):
            held = [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
            assert len(held) == 4 and max(held) < sum(held) / 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
