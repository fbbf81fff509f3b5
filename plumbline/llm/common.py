"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SALTS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """The place of a public vocabulary file, installed on every executor."""
    return public_tokenizers.path(name)


def crc_bucket(column: str | Column, buckets: int) -> Column:
    """crc32 of the value written as text, modulo ``buckets`` (null for null)."""
    value = F.col(column) if isinstance(column, str) else column
    return F.crc32(value.cast("string").cast("binary")) % buckets


def map_rows(df: DataFrame, columns: list[str], step: Callable, schema: StructType) -> DataFrame:
    """``step(list per column, ...) -> list per output column`` over Arrow batches.

    Only ``columns`` are read, so further columns of ``df``, whatever their names,
    reach neither Python nor the scan. Batches are cut to ``ROWS`` rows before
    they become Python objects.
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                out = step(*(part.column(i).to_pylist() for i in range(part.num_columns)))
                arrays = [pa.array(values, type=f.type) for values, f in zip(out, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.select(*columns).mapInArrow(run, schema)


ROWS = 1000


def min_by_group(df: DataFrame, key: str, value: str, salt_from: list[str], salts: int = SALTS) -> DataFrame:
    """One row per ``key`` and salt: ``key, salt, group_min``, the least ``value`` of the key.

    A key that holds a third of all rows is spread over ``salts`` tasks: partial
    minima per salt first, then at most ``salts`` rows meet per key. Join the
    result back on the key and :func:`salt` of the same columns.
    """
    parts = df.groupBy(key, salt(salt_from, salts).alias("salt")).agg(F.min(value).alias("part_min"))
    return parts.select(key, "salt", F.min("part_min").over(Window.partitionBy(key)).alias("group_min"))


def salt(columns: list[str], salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def with_group_min(df: DataFrame, key: str, value: str, out: str, salt_from: list[str], salts: int = SALTS) -> DataFrame:
    """``df`` with the least ``value`` among rows of the same (non-null) ``key`` in column ``out``."""
    least = min_by_group(df, key, value, salt_from, salts).withColumnRenamed("group_min", out)
    return df.withColumn("salt", salt(salt_from, salts)).join(least, [key, "salt"]).drop("salt")


def held_out(id_col: str = "doc_id", buckets: int = 5, left: int = 0) -> Column:
    """Whether crc32 of the id as text leaves ``left`` modulo ``buckets`` (false for a null id)."""
    return F.coalesce(crc_bucket(id_col, buckets) == left, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, bound: int) -> DataFrame:
    """``docs`` columns and ``label_col`` of about ``bound`` labelled documents, none of them held out.

    The documents are those whose id hashes below a share taken from one count of the
    labels. Several labels of one id count as the largest. The ids of the sample,
    bounded by ``bound``, are broadcast, so the documents are filtered where they are
    read. Where ids repeat so often that their rows are more than twice ``bound``, equal
    rows count once and a hash of the whole row chooses among the rest.
    """
    known = (
        labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max(label_col).alias(label_col))
    )
    n = known.count()
    share = min(1.0, bound / n) if n else 1.0
    picked = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * float(1 << 20))
    rows = docs.select("doc_id").join(F.broadcast(picked), "doc_id").count()
    found = docs.join(F.broadcast(picked), "doc_id")
    if rows <= 2 * bound:
        return found
    return found.filter(F.pmod(F.xxhash64(*docs.columns), F.lit(1 << 20)) < bound / rows * float(1 << 20)).dropDuplicates()


_held: dict[str, object] = {}


def per_worker(key: str, build: Callable):
    """What ``build`` makes, kept in this Python worker from task to task.

    One object at a time: a worker that turns to another operator lets the last
    one's vocabulary and caches go.
    """
    if key not in _held:
        _held.clear()
        _held[key] = build()
    return _held[key]
