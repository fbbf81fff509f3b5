"""SimHash near-duplicates: fingerprints, exact tiled comparison, components.

Fingerprints are compared without candidates or bands, so no pair within the radius is
missed. Tiles gather fingerprints whose two halves have the same population counts.
Population counts of parts differ by no more than the parts do, so a pair of tiles is
skipped when its counts differ by more than the radius in sum; the same test is made
again inside a tile on quarters. What is left is numpy exclusive-or and bit counts.

Tasks: a document is hashed where it is read. Equal fingerprints are merged before
tiles are made, so a hot text costs one fingerprint. A tile holds about
``tile_rows`` fingerprints (fuller ones are split by hash). A task reports a spanning
forest of the links it finds, never all pairs.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from plumbline.llm.common import map_rows, min_by_group, salt, with_group_min
from plumbline.llm.components import components
from plumbline.session import materialise

SEED = 42
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The 64-bit SimHash of one text as a signed long."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = max(0, len(words) - shingle)
    cuts = map(slice, starts[: last + 1].tolist(), ends[len(words) - last - 1 :].tolist())
    hashes = np.fromiter(map(xxh64_intdigest, map(joined.__getitem__, cuts), repeat(SEED)), np.uint64, last + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), BLOCK):
        part = hashes[i : i + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``id_col, fp`` per row: A-Z lower-cased, ASCII white space splits words.

    Fewer words than ``shingle``: one shingle of them all; no word or null text:
    fingerprint 0. Rows are kept as they are, repeated and null ids too.
    """
    schema = T.StructType([docs.schema[id_col], T.StructField("fp", T.LongType())])
    return map_rows(
        docs, [id_col, text_col], lambda ids, texts: (ids, [fingerprint(t, shingle) for t in texts]), schema
    )


class _Forest:
    """Union of positions by vectorised hooking to the smaller root."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def join(self, x: np.ndarray, y: np.ndarray) -> None:
        while True:
            x, y = self.parent[x], self.parent[y]
            apart = x != y
            if not apart.any():
                return
            x, y = x[apart], y[apart]
            np.minimum.at(self.parent, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := self.parent[self.parent], self.parent):
                self.parent = up


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int, int]]]:
    """Fingerprints ordered by the counts of their two low quarters, and each run of equal counts."""
    first = np.bitwise_count(values & np.uint64(0xFFFF)).astype(np.int64)
    second = np.bitwise_count(values >> np.uint64(16) & np.uint64(0xFFFF)).astype(np.int64)
    order = np.argsort(first * 32 + second, kind="stable")
    values, first, second = values[order], first[order], second[order]
    cut = np.flatnonzero(np.diff(first * 32 + second, prepend=-1)).tolist() + [len(values)]
    return values, order, [(a, b, int(first[a]), int(second[a])) for a, b in zip(cut, cut[1:])]


def tile_links(left: np.ndarray, right: np.ndarray, high_gap: int, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs within ``radius`` bits between two tiles (or inside one)."""
    a, _, runs_a = _runs(left)
    b, _, runs_b = (a, None, runs_a) if same else _runs(right)
    nodes = a if same else np.concatenate([a, b])
    shift = 0 if same else len(a)
    forest = _Forest(len(nodes))
    for a0, a1, a_first, a_second in runs_a:
        near = [r for r in runs_b if abs(r[2] - a_first) + abs(r[3] - a_second) + high_gap <= radius and (not same or r[1] > a0)]
        for b0, b1 in _merged(near):
            step = max(1, BLOCK * 4 // (b1 - b0))
            for i in range(a0, a1, step):
                block = a[i : min(i + step, a1)]
                close = np.bitwise_count(block[:, None] ^ b[None, b0:b1]) <= radius
                if same:
                    at = np.arange(i, i + len(block))[:, None] < np.arange(b0, b1)[None, :]
                    close &= at
                if close.any():
                    x, y = np.nonzero(close)
                    forest.join(x + i, y + b0 + shift)
    child = np.flatnonzero(forest.parent != np.arange(len(nodes)))
    return nodes[child], nodes[forest.parent[child]]


def _merged(runs: list) -> list[tuple[int, int]]:
    """Neighbouring runs as one slice, so that numpy is called on long rows."""
    out: list[tuple[int, int]] = []
    for b0, b1, *_ in runs:
        if out and out[-1][1] == b0:
            out[-1] = (out[-1][0], b1)
        else:
            out.append((b0, b1))
    return out


EDGES = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def links(distinct_fps: DataFrame, radius: int = 4, tile_rows: int = 16384) -> DataFrame:
    """``a, b``: a spanning forest of all pairs of ``distinct_fps(fp)`` within ``radius`` bits.

    ``distinct_fps`` must hold each fingerprint once and be cheap to read again.
    """
    spark = distinct_fps.sparkSession
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    placed = distinct_fps.select("fp", F.bit_count(low).alias("p"), F.bit_count(high).alias("q"))
    # at most 33 * 33 rows, whatever the input
    splits = placed.groupBy("p", "q").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("parts"))
    tiles = materialise(
        placed.join(F.broadcast(splits), ["p", "q"])
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .groupBy("p", "q", "part")
        .agg(F.collect_list("fp").alias("fps")),
        "tiles",
    )
    offsets = [
        (i, j)
        for i in range(radius + 1)
        for j in range(-radius, radius + 1)
        if i + abs(j) <= radius and (i, j) >= (0, 0)
    ]
    steps = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in offsets)))
    # pairs of tiles by name: the table of counts (at most 33 * 33 rows) says which parts exist,
    # so no key gathers the tiles of a frequent count
    names = (
        tiles.select(F.col("p").alias("p_a"), F.col("q").alias("q_a"), F.col("part").alias("part_a"), steps.alias("d"))
        .withColumns({"p": F.col("p_a") + F.col("d.i"), "q": F.col("q_a") + F.col("d.j")})
        .join(F.broadcast(splits), ["p", "q"])
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("own", (F.col("d.i") == 0) & (F.col("d.j") == 0))
        .filter("not own or part_a <= part")
        .select("p_a", "q_a", "part_a", "p", "q", "part", F.abs("d.j").alias("high_gap"), "own")
    )
    lefts = tiles.select(F.col("p").alias("p_a"), F.col("q").alias("q_a"), F.col("part").alias("part_a"), F.col("fps").alias("left"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)

    def compare(frames):
        for frame in frames:
            for x, y, gap, same in zip(frame["left"], frame["fps"], frame["high_gap"], frame["same"]):
                a, b = tile_links(x.astype(np.int64).view(np.uint64), y.astype(np.int64).view(np.uint64), gap, radius, same)
                yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    # payloads meet the names tile by tile; the number is given, so that small tiles with
    # long comparisons are not put together
    pairs = names.join(lefts, ["p_a", "q_a", "part_a"]).repartition(tasks, "p", "q", "part").join(tiles, ["p", "q", "part"])
    same = F.col("own") & (F.col("part_a") == F.col("part"))
    return pairs.select("left", "fps", "high_gap", same.alias("same")).mapInPandas(compare, EDGES)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4
) -> DataFrame:
    """``id_col, fp, component_id`` per row of ``docs``.

    Rows link when their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the least id that a row reaches, its own included (null only
    if every row it reaches has a null id). Texts without a word share fingerprint
    0 and link like any other. An empty table gives an empty table.
    """
    hashed = materialise(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    least = materialise(min_by_group(hashed, "fp", id_col, [id_col]), "least")
    nodes = materialise(least.groupBy("fp").agg(F.min("group_min").alias("least_id")), "nodes")
    roots = components(materialise(links(nodes.select("fp"), radius), "links"))
    rooted = materialise(
        nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
            "fp", "least_id", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )
    by_fp = with_group_min(rooted, "root", "least_id", "component_id", ["fp"]).select("fp", "component_id")
    by_part = least.select("fp", "salt").join(by_fp, "fp")
    return (
        hashed.withColumn("salt", salt([id_col]))
        .join(by_part, ["fp", "salt"])
        .select(F.col(id_col), "fp", "component_id")
    )


def hex_fingerprint(column: str = "fp"):
    """A signed fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
