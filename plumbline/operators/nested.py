"""JSON objects inside texts: found by matching braces, read to one row per value.

Braces are matched over the pieces of a text (quoted strings, braces, the rest), so a brace or
comma inside a quoted value ends nothing. Braces without a partner stand for themselves, and
the objects around or after them are still found. Only texts with a brace are cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.session import materialise

# A quoted string ends on its line; all pieces together are the text.
PIECE = r'"[^"\\\n]*(?:\\.[^"\\\n]*)*"|[{}]|[^{}"]+|"'


def objects(rows: DataFrame, keys: list[str], text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(keys, object_ix, json)`` of the outermost closed braces, and ``(keys, text)`` of what is left.

    The second frame has every row of ``rows``, blanks in place of its objects. ``keys`` name a
    row; null texts have no object.
    """
    holds = F.col(text).contains("{")
    pieces = T.positions(rows.filter(holds).select(*keys, text), keys, F.regexp_extract_all(F.col(text), F.lit(PIECE), F.lit(0)), "pos", "piece")
    order = Window.partitionBy(*keys).orderBy("pos")
    upto, on = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    step = F.when(F.col("piece") == "{", 1).when(F.col("piece") == "}", -1).otherwise(0)
    level = (
        pieces.withColumn("level", F.sum(step).over(upto))
        # closed braces without an open one lie below, open ones that are never closed above
        .withColumn("below", F.least(F.lit(0), F.min("level").over(upto)))
        .withColumn("depth", F.col("level") - F.greatest("below", F.min("level").over(on)))
    )
    before = F.coalesce(F.lag("depth").over(order), F.lit(0))
    marked = level.withColumn("inside", (F.col("depth") > 0) | (before > 0)).withColumn(
        "object_ix", F.sum(((F.col("depth") > 0) & (before == 0)).cast("bigint")).over(upto) - 1
    )
    marked = materialise(marked.select(*keys, "pos", "piece", "inside", "object_ix"), "pieces")

    def joined(parts: DataFrame, by: list[str], name: str) -> DataFrame:
        listed = parts.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("_p"))
        return listed.select(*by, F.array_join(F.transform("_p", lambda p: p["piece"]), "").alias(name))

    found = joined(marked.filter("inside"), [*keys, "object_ix"], "json")
    outside = marked.withColumn("piece", F.when(F.col("inside"), F.lit(" ")).otherwise(F.col("piece")))
    cut = joined(outside, keys, text)
    return found, cut.unionByName(rows.filter(~F.coalesce(holds, F.lit(False))).select(*keys, text))


def values(found: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, object_ix, path, key, value`` of every scalar in ``found(keys, object_ix, json)``.

    ``path`` is written as in JSON path, ``key`` is the last name on it; a JSON null has a null value.
    Text that is no JSON gives no row, an empty object or array none either. One round per
    level of nesting, whatever the number of texts.
    """
    ids = [*keys, "object_ix"]
    level = found.select(*ids, F.lit("$").alias("path"), F.lit(None).cast("string").alias("key"), F.try_parse_json(F.col("json")).alias("v"))
    level = level.filter("v is not null")
    leaves = None
    while True:
        level = materialise(level.withColumn("kind", F.schema_of_variant("v")), "level")
        holder = F.col("kind").startswith("OBJECT") | F.col("kind").startswith("ARRAY")
        flat = level.filter(~holder).select(*ids, "path", "key", F.col("v").cast("string").alias("value"))
        leaves = flat if leaves is None else leaves.unionByName(flat)
        deeper = level.filter(holder)
        if deeper.isEmpty():
            return leaves
        inner = deeper.lateralJoin(deeper.sparkSession.tvf.variant_explode(F.col("v").outer()).toDF("_pos", "_key", "_value"))
        step = F.when(F.col("_key").isNull(), F.concat(F.lit("["), "_pos", F.lit("]"))).otherwise(F.concat(F.lit("."), "_key"))
        level = inner.select(
            *ids, F.concat("path", step).alias("path"), F.coalesce("_key", "key").alias("key"), F.col("_value").alias("v")
        )
