"""Exact nearest neighbours by inner product: a block matrix join with int8 tiles.

Queries and candidates are cut into tiles. Every pair of tiles is one product: vectors
are scaled to int8 once, the product of two int8 tiles gives each inner product up to
a bound on the quantisation error, and only candidates that may still be among the
best ``k`` are computed again in double precision from the original floats. The best
of each pair of tiles are merged by a heap along the candidate tiles of a unit, then
per query over all units.

A candidate tile holds about ``tile_rows`` vectors and a query tile about ``query_rows``,
whatever the input and however often an id is repeated. A unit of work is a group of
candidate tiles and a stripe of query tiles: it holds its candidates (``TILES_A_GROUP``
tiles) and the query tile at hand. So a candidate is sent once per stripe and a query
once per group, and what is shuffled is ``groups * queries + stripes * rows`` vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.session import materialise

TILE_ROWS = 2048
TILES_A_GROUP = 32
QUERY_ROWS = 512
TILES_A_STRIPE = 256
TASKS = 20_000  # units beyond this number share tasks


def usable(column: str) -> Column:
    """Whether a vector takes part: not null, not all zero, every component finite."""
    v = F.col(column)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0), F.lit(False))


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, the scale of each, and the length of what rounding left out of each."""
    scale = np.abs(vectors).max(axis=1) / 127.0
    codes = np.rint(vectors / scale[:, None])
    left = np.linalg.norm(vectors - codes * scale[:, None], axis=1)
    return codes.astype(np.int8), scale, left


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added from the first component to the last.

    The order is the same for every row, so equal vectors get equal scores.
    """
    return np.cumsum(vectors.astype(np.float64) * query.astype(np.float64), axis=1)[:, -1]


class Tile:
    """Vectors as they are and as int8 codes, with lengths for the error bound."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        wide = vectors.astype(np.float64)
        self.codes, self.scale, self.left = quantise(wide)
        self.length = np.linalg.norm(wide, axis=1)


def tile_best(queries: Tile, tile: Tile, k: int, best: list[list[tuple[float, int]]]) -> None:
    """Merge the candidates of ``tile`` into the heaps ``best`` (score, minus id) of the queries.

    ``|<q, c> - s_q s_c <q8, c8>| <= |q| r_c + r_q |c| + r_q r_c`` with ``r`` the length
    of what quantisation left out. int8 products of a tile are exact in float32 up to
    1000 components and in float64 beyond.
    """
    kind = np.float32 if queries.codes.shape[1] <= 1000 else np.float64
    about = (queries.codes.astype(kind) @ tile.codes.T.astype(kind)).astype(np.float64)
    about *= queries.scale[:, None] * tile.scale[None, :]
    slack = (
        queries.length[:, None] * tile.left[None, :]
        + queries.left[:, None] * (tile.length + tile.left)[None, :]
    ) * (1 + 1e-9) + 1e-12 * queries.length[:, None] * tile.length[None, :]
    high, low = about + slack, about - slack
    own = queries.ids[:, None] == tile.ids[None, :]
    high[own] = low[own] = -np.inf
    kth = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] >= k else np.full(len(best), -np.inf)
    for j, heap in enumerate(best):
        floor = kth[j]
        if len(heap) == k:
            floor = max(floor, heap[0][0])
        at = np.flatnonzero((high[j] >= floor) & ~own[j])
        if not len(at):
            continue
        scores = exact(tile.vectors[at], queries.vectors[j])
        order = np.lexsort((tile.ids[at], -scores))[:k]
        for score, vec_id in zip(scores[order].tolist(), tile.ids[at][order].tolist(), strict=True):
            item = (score, -vec_id)
            if len(heap) < k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)
            else:
                break


def _tiles(vectors: DataFrame, id_col: str, vec_col: str, rows: int, name: str, salt: Column) -> DataFrame:
    """``tile, ids, vectors`` with about ``rows`` vectors each, by a hash of the id and ``salt``.

    The salt tells rows of one id apart, so that they spread over the tiles. The number of
    tiles follows from one count.
    """
    n = max(1, -(-vectors.count() // rows))
    return (
        vectors.groupBy(F.pmod(F.xxhash64(id_col, salt), F.lit(n)).cast("int").alias(name))
        .agg(F.collect_list(F.struct(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))).alias("both"))
        .select(name, F.col("both.id").alias(f"{name}_ids"), F.flatten("both.v").alias(f"{name}_vectors"))
    )


RESULT = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def search(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 20,
    tile_rows: int = TILE_ROWS,
    query_rows: int = QUERY_ROWS,
    group_tiles: int = TILES_A_GROUP,
    stripe_tiles: int = TILES_A_STRIPE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of the largest inner product per query row.

    Candidates are all other rows; ties go to the smaller id. Vectors that are null,
    zero or hold a null or non-finite component take no part, nor do rows with a null
    id. Rows that repeat an id are candidates each, and share one list as queries; a row
    never finds its own id. All vectors must have one length, else the product raises. No query or no candidate:
    an empty table.
    """
    spark = vectors.sparkSession
    valid = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"), is_query.alias("asks")
    ).filter(F.col("id").isNotNull() & usable("v"))
    valid = materialise(valid, "vectors")
    # rows are numbered as they are read from written files, the same when a task is repeated
    numbered = valid.select("id", "v", F.monotonically_increasing_id().alias("n"))
    candidates = materialise(_tiles(numbered, "id", "v", tile_rows, "c", F.col("n")), "candidates")
    asking = valid.filter("asks").select("id", "v").distinct()
    queries = materialise(_tiles(asking, "id", "v", query_rows, "q", F.col("v")), "queries")
    # the stated query set against all rows, in blocks: a candidate tile goes to every
    # stripe of queries, a query tile to every group of candidates
    tiles = candidates.count()
    groups = max(1, -(-tiles // group_tiles), min(tiles, 2 * spark.sparkContext.defaultParallelism))
    stripes = max(1, -(-queries.count() // stripe_tiles))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    placed = candidates.select(
        F.pmod("c", F.lit(groups)).cast("int").alias("g"),
        every(stripes).alias("s"),
        F.lit(False).alias("asks"),
        F.col("c_ids").alias("ids"),
        F.col("c_vectors").alias("vectors"),
    )
    asked = queries.select(
        every(groups).alias("g"), F.pmod("q", F.lit(stripes)).cast("int").alias("s"), F.lit(True).alias("asks"), "q_ids", "q_vectors"
    )
    units = placed.union(asked).repartition(min(groups * stripes, TASKS), "g", "s").sortWithinPartitions("g", "s", "asks")
    arrow = to_arrow_schema(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                g, s, asks, ids, values = (batch.column(c)[i] for c in range(5))
                now = g.as_py(), s.as_py()
                if now != unit:
                    unit, held = now, []
                tile = _tile(ids, values)
                if not asks.as_py():
                    held.append(tile)  # the candidates of a unit come before its queries
                    continue
                best: list[list[tuple[float, int]]] = [[] for _ in tile.ids]
                for other in held:
                    tile_best(tile, other, k, best)
                rows = [(int(q), -i, score) for q, heap in zip(tile.ids, best, strict=True) for score, i in heap]
                columns = zip(*rows, strict=True) if rows else ([], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    found = units.mapInArrow(run, RESULT)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _tile(ids: pa.Scalar, values: pa.Scalar) -> Tile:
    keys = ids.values.to_numpy()
    return Tile(keys, values.values.to_numpy().reshape(len(keys), -1))
