"""Similar terms by a set-similarity join on letter grams.

The similarity of two terms is the Dice coefficient of their sets of grams. Terms are
never paired with all others: the grams of a term are put in one global order, rarest
first, and two terms that are similar enough share one of the first few (the prefix
filter). Terms whose sizes cannot reach the threshold are ruled out before the rest is
counted.

A gram held by most words comes last in every prefix, whether frequencies are those of a whole
vocabulary (:func:`prefixes`) or of the groups that a task holds (:func:`similar_terms`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from plumbline.functions import skew
from plumbline.functions.batches import changes, cut, whole_groups
from plumbline.functions.text import exploded, r6
from plumbline.session import materialise

SIZE = 3
THRESHOLD = 0.6
BLOCK = 1 << 22


def grams(term: Column, size: int = SIZE) -> Column:
    """The distinct grams of a term with one blank at each end; a short term is one gram."""
    padded = F.concat(F.lit(" "), term, F.lit(" "))
    starts = F.sequence(F.lit(1), F.greatest(F.length(padded) - (size - 1), F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(padded, i, F.lit(size))))


def prefixes(terms: DataFrame, threshold: float = THRESHOLD, size: int = SIZE) -> DataFrame:
    """``term, n_grams, prefix`` per distinct term.

    A similar term holds ``t / (2 - t)`` of a term's grams at least (``t`` the threshold),
    so one of the others and one more, taken rarest first, must be shared.
    """
    vocabulary = materialise(terms.select("term").distinct(), "vocabulary")
    rows = exploded(vocabulary, ["term"], grams(F.col("term"), size), "gram")
    frequency = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    ranked = skew.lookup(rows, frequency, "gram", "df", ["term"])
    share = threshold / (2 - threshold)
    # a hair less, so that rounding never takes a gram away
    needed = F.ceil(F.col("n_grams") * share - 1e-9)
    return (
        ranked.groupBy("term")
        .agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("_ranked"))
        .withColumn("n_grams", F.size("_ranked"))
        .select(
            "term",
            F.col("n_grams").cast("bigint").alias("n_grams"),
            F.transform(F.slice("_ranked", F.lit(1), (F.col("n_grams") - needed + 1).cast("int")), lambda g: g["gram"]).alias("prefix"),
        )
    )


def similar_terms(
    asked: DataFrame, held: DataFrame, group: str, threshold: float = THRESHOLD, size: int = SIZE, packed: bool = False, block: int = BLOCK
) -> DataFrame:
    """``group, term, matched_term, dice``: terms of ``asked`` with the terms of ``held`` in the same
    ``group`` that reach ``threshold``.

    Both frames hold ``group, term``; with ``packed`` a row may hold several terms, made one
    string by :func:`text.packed`. Terms travel once, by group, and neither grams nor pairs do: a task holds
    whole groups, ranks the grams of their terms rarest first among those (any one order
    will do for the prefixes) and looks at some ``block`` pairs at a time, only
    those that share a gram of both prefixes.
    """
    sides = [df.select(group, "term", F.lit(flag).alias("_held")) for df, flag in ((asked, False), (held, True))]
    rows = sides[0].unionByName(sides[1]).filter(F.col(group).isNotNull() & F.col("term").isNotNull())
    schema = StructType([rows.schema[group], StructField("term", StringType()), StructField("matched_term", StringType()), StructField("dice", DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, group):
            at, row = changes([table.column(group)]), np.arange(len(table))
            if packed:
                terms, row = cut(table.column("term"))
            else:
                terms = table.column("term").combine_chunks()
            encoded = terms.dictionary_encode()
            is_held = table.column("_held").combine_chunks().to_numpy(zero_copy_only=False)[row]
            first = np.flatnonzero(np.concatenate([[True], np.diff(at) > 0]))
            for where, term, other, dice in _similar(encoded.dictionary, encoded.indices.to_numpy().astype(np.int64), at[row].astype(np.int64), is_held, threshold, size, block):
                columns = [table.column(group).combine_chunks().take(pa.array(first[where])), *(encoded.dictionary.take(pa.array(x)) for x in (term, other)), pa.array(dice)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.repartition(group).sortWithinPartitions(group).mapInArrow(run, schema).withColumn("dice", r6(F.col("dice")))


def _grams(terms: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`grams`: codes of the terms' grams in the order of terms, without repeats, and where each term's begin."""
    padded = pc.binary_join_element_wise(" ", terms, " ", "")
    length = pc.utf8_length(padded).to_numpy().astype(np.int64)
    points = np.frombuffer("".join(padded.to_pylist()).encode("utf-32-le"), np.uint32)
    begin = np.cumsum(length) - length
    n = np.maximum(length - (size - 1), 1)
    owner = np.repeat(np.arange(len(terms)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + begin[owner]
    code = np.zeros(len(owner), np.int64)
    for k in range(size):
        # nothing follows where a short term ends
        at = start + k
        point = np.where(at < (begin + length)[owner], points[np.minimum(at, len(points) - 1)].astype(np.int64) + 1, 0)
        code = np.unique(code * (1 << 21) + point, return_inverse=True)[1]
    both = np.unique(owner * (code.max(initial=0) + 1) + code)
    owner, code = np.divmod(both, code.max(initial=0) + 1)
    return code, np.searchsorted(owner, np.arange(len(terms) + 1))


def _similar(terms: pa.Array, code: np.ndarray, at: np.ndarray, is_held: np.ndarray, threshold: float, size: int, block: int) -> Iterator[tuple]:
    """Groups, terms, similar terms and their Dice coefficient; entry ``i`` is term ``code[i]`` of group ``at[i]``."""
    n_terms = max(len(terms), 1)
    asked, held = (np.unique((at * n_terms + code)[side]) for side in (~is_held, is_held))
    held = held[np.isin(held // n_terms, asked // n_terms)]
    asked = asked[np.isin(asked // n_terms, held // n_terms)]
    if not len(asked):
        return
    gram, begin = _grams(terms, size)
    n = np.diff(begin)
    owner = np.repeat(np.arange(len(n)), n)
    n_grams = gram.max() + 1
    # prefixes: a term's rarest grams; one that is similar enough shares one of them
    ranked = np.lexsort((gram, np.bincount(gram)[gram], owner))
    share = threshold / (2 - threshold)
    # a hair less, so that rounding never takes a gram away
    kept = n - np.ceil(n * share - 1e-9).astype(np.int64) + 1
    front = ranked[np.arange(len(gram)) - begin[owner] < kept[owner]]
    start = np.cumsum(kept) - kept
    # a bit per gram: those set for one term only tell how many grams the other lacks at least
    mask = np.zeros(len(n), np.uint64)
    np.bitwise_or.at(mask, owner, np.uint64(1) << (gram.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(58)))
    all_grams = owner * n_grams + gram

    def cut_up(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each entry's prefix as group and gram, and the entry."""
        group, term = np.divmod(entries, n_terms)
        which = np.repeat(np.arange(len(entries)), kept[term])
        offset = np.arange(len(which)) - np.repeat(np.cumsum(kept[term]) - kept[term], kept[term])
        return group[which] * n_grams + gram[front[start[term[which]] + offset]], which

    key, holder = cut_up(held)
    order = np.argsort(key, kind="stable")
    key, holder = key[order], holder[order]
    sought, asker = cut_up(asked)
    low, high = np.searchsorted(key, sought, "left"), np.searchsorted(key, sought, "right")
    cost = np.cumsum(high - low)
    stops = np.searchsorted(asker, np.arange(len(asked)), "right")  # an entry's prefix is never parted
    done = 0
    while done < len(asked):
        a = stops[done - 1] if done else 0
        limit = (cost[a - 1] if a else 0) + block
        done = max(done + 1, int(np.searchsorted(cost[stops - 1], limit, "right")))
        b = stops[done - 1]
        m = (high - low)[a:b]
        left = np.repeat(asker[a:b], m)
        right = holder[np.repeat(low[a:b] - np.cumsum(m) + m, m) + np.arange(m.sum())]
        x, y = asked[left] % n_terms, held[right] % n_terms
        most = n[x] - np.bitwise_count(mask[x] & ~mask[y]).astype(np.int64)
        fits = 2.0 * most >= (threshold - 1e-9) * (n[x] + n[y])
        pair = np.unique(left[fits] * len(held) + right[fits])
        left, right = np.divmod(pair, len(held))
        x, y = asked[left] % n_terms, held[right] % n_terms
        which = np.repeat(np.arange(len(x)), n[x])
        own = gram[np.repeat(begin[x] - np.cumsum(n[x]) + n[x], n[x]) + np.arange(n[x].sum())]
        sought_grams = y[which] * n_grams + own
        place = np.minimum(np.searchsorted(all_grams, sought_grams), len(all_grams) - 1)
        shared = np.bincount(which, all_grams[place] == sought_grams, len(x))
        dice = 2.0 * shared / (n[x] + n[y])
        enough = dice >= threshold - 1e-12
        if enough.any():
            yield asked[left[enough]] // n_terms, x[enough], y[enough], dice[enough]
