"""Names of a dictionary in texts: longest phrase first, without overlaps.

A name is a phrase of tokens. A text's tokens are looked up by the first token of a name, and
only where one starts are the next tokens joined to phrases and compared. Tables of names
are broadcast only if their rows were counted and are few; otherwise common tokens and
phrases are resolved on the map side and the rest meet by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import skew
from plumbline.functions import text as T
from plumbline.session import materialise

# a dictionary of so many rows goes to every executor
BROADCAST_ROWS = 100_000


def dictionary(names: DataFrame, name: str = "name", label: str = "label") -> DataFrame:
    """``phrase, first, n_tokens, label`` of ``names``: lower-case tokens joined by a blank.

    Names without a token are left out; a phrase with several labels has the first of them.
    """
    tokens = names.select(T.tokens(F.col(name)).alias("_t"), F.col(label).alias("label")).filter(F.size("_t") > 0)
    return (
        tokens.select(F.array_join("_t", " ").alias("phrase"), F.col("_t")[0].alias("first"), F.size("_t").alias("n_tokens"), "label")
        .groupBy("phrase", "first", "n_tokens")
        .agg(F.min("label").alias("label"))
    )


def _meet(rows: DataFrame, table: DataFrame, key: str, spread: list[str], broadcast_rows: int) -> DataFrame:
    """Inner join with a ``table`` of one row per ``key``, whatever the size of the table and of the keys."""
    if table.count() <= broadcast_rows:
        return rows.join(F.broadcast(table), key)
    asked = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_asked"))
    found = skew.lookup(rows, table.join(asked, key), key, "_asked", spread)
    return found.filter("_asked is not null").drop("_asked")


def _candidates(docs: DataFrame, known: DataFrame, key: str, text: str, broadcast_rows: int) -> DataFrame:
    """``key, ix, n_tokens, label, char_start, char_end``: the longest name that starts at each token."""
    longest = known.agg(F.max("n_tokens")).first()[0]
    if longest is None:
        longest = 1
    starts = materialise(known.groupBy("first").agg(F.collect_set("n_tokens").alias("lengths")), "first-tokens")

    def found(group: int):
        return F.regexp_extract_all(F.col(text), F.lit(T.GAP_AND_TOKEN), F.lit(group))

    cut = docs.select(
        key,
        found(2).alias("_tokens"),
        T.running_totals(F.transform(found(0), F.length)).alias("_ends"),
    )
    at = F.transform(
        "_tokens",
        lambda t, i: F.struct(
            i.alias("ix"),
            F.lower(t).alias("first"),
            F.transform(F.slice("_tokens", i + 1, F.lit(longest)), F.lower).alias("words"),
            F.slice("_ends", i + 1, F.lit(longest)).alias("ends"),
            F.length(t).alias("width"),
        ),
    )
    placed = cut.select(key, F.explode_outer(at).alias("_p")).filter("_p is not null").select(key, "_p.*")
    begun = _meet(placed, starts, "first", [key, "ix"], broadcast_rows)
    sized = begun.select(key, "ix", "words", "ends", "width", F.explode("lengths").alias("n_tokens")).filter(
        F.col("n_tokens") <= F.size("words")
    )
    phrases = sized.select(
        key,
        "ix",
        F.array_join(F.slice("words", F.lit(1), F.col("n_tokens")), " ").alias("phrase"),
        (F.col("ends")[0] - F.col("width")).alias("char_start"),
        F.col("ends")[F.col("n_tokens") - 1].alias("char_end"),
    )
    met = _meet(phrases, known.select("phrase", "n_tokens", "label"), "phrase", [key, "ix"], broadcast_rows)
    best = F.max_by(F.struct("n_tokens", "label", "char_start", "char_end"), "n_tokens")
    return met.groupBy(key, "ix").agg(best.alias("_b")).select(key, F.col("ix").cast("bigint").alias("ix"), "_b.*")


def detect_names(
    docs: DataFrame, names: DataFrame, key: str, text: str, name: str = "name", label: str = "label", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """The names in the texts of ``docs(key, text)``, without overlaps.

    Returns ``key, token_ix, n_tokens, label, char_start, char_end``. Names are compared by
    their lower-case tokens, whatever stands between these. From left to right the
    longest name that starts at a token is taken, and the next one starts after it. Rows
    that repeat ``key`` are not told apart. Null and empty texts have no names.
    """
    known = materialise(dictionary(names, name, label), "names")
    found = _candidates(docs, known, key, text, broadcast_rows).withColumn("_end", F.col("ix") + F.col("n_tokens"))
    # names that overlap, directly or over others, form an island; few are longer than one
    before = Window.partitionBy(key).orderBy("ix").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(key).orderBy("ix").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.coalesce(F.max("_end").over(before), F.lit(-1))
    islands = found.withColumn("_new", (F.col("ix") >= reach).cast("int")).withColumn("_island", F.sum("_new").over(upto))
    spans = F.array_sort(F.collect_list(F.struct("ix", "_end", "n_tokens", "label", "char_start", "char_end")))
    # the end of the last span taken decides whether the next one is
    taken = F.aggregate(
        "_spans",
        F.filter("_spans", lambda s: F.lit(False)),
        lambda acc, s: F.when((F.size(acc) == 0) | (F.element_at(acc, -1)["_end"] <= s["ix"]), F.concat(acc, F.array(s))).otherwise(acc),
    )
    return (
        islands.groupBy(key, "_island")
        .agg(spans.alias("_spans"))
        .select(key, F.explode(taken).alias("_s"))
        .select(key, F.col("_s.ix").alias("token_ix"), F.col("_s.n_tokens").cast("bigint").alias("n_tokens"), "_s.label", "_s.char_start", "_s.char_end")
    )
