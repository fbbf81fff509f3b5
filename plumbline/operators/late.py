"""Late interaction with a candidate step: inverted lists of vector sets.

A set of vectors stands for one text. The similarity of a query set to another is the mean,
over the query's vectors, of the best cosine with a vector of the other. Every vector belongs
to its nearest centroid; a set is listed under the centroids of its vectors, and a query is
scored only against sets listed under the centroids nearest to its own vectors, ``probes``
for each. With as many probes as centroids the lists are complete and the result exact.

Every set lies in one part, with the sets that have most of their vectors in the same list, and
brings its lists along. A part of about ``LIST_PART`` sets meets a block of the queries that probe
one of its lists, so a query meets a set once, however many lists they share, and only each
query's best of that part leave the task.

Scores of candidates are exact in any case. A first pass in single precision leaves out sets that
cannot be among the best by more than its largest possible error; the others are scored in double.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.functions.text import r6
from plumbline.session import materialise

CENTROIDS = 32
PROBES = 4
SAMPLE = 8192
STEPS = 8
LIST_PART = 4096  # sets of ``SET_SIZE`` vectors held by a task
SET_SIZE = 8
QUERY_BLOCK = 4096  # queries that meet a part in one task
LEAST_BLOCK = 256
UNITS = 32  # parts times blocks, where there are queries enough
COLUMNS = 256  # sets and vectors of queries scored by one product: small enough for a core's cache
QUERY_VECTORS = 512


def _unit_length(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)


def fit_centroids(sets: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE) -> np.ndarray:
    """Directions of up to ``centroids`` clusters of the vectors of ``sets(set_id, vectors)``.

    Learned from about ``sample`` vectors, whatever the input, picked by a hash of set and
    place: the first are the start, then ``STEPS`` rounds of assignment and mean.
    """
    rows = sets.select("set_id", F.posexplode("vectors").alias("pos", "vector")).filter("vector is not null")
    total = rows.count()
    mixed = F.pmod(F.xxhash64("set_id", "pos"), F.lit(1 << 30))
    picked = rows.withColumn("h", mixed).filter(F.col("h") < F.lit(min(1.0, sample / max(total, 1)) * float(1 << 30)))
    found = picked.orderBy("h", "set_id", "pos").limit(2 * sample).select("vector").toArrow()
    if not found.num_rows:
        return np.zeros((0, 0))
    vectors = _unit_length(np.array(found.column(0).to_pylist(), np.float64))
    centres = np.unique(vectors, axis=0)
    centres = centres[np.linspace(0, len(centres) - 1, min(centroids, len(centres))).astype(int)]
    for _ in range(STEPS):
        nearest = (vectors @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, vectors)
        kept = np.bincount(nearest, minlength=len(centres)) > 0
        centres = np.where(kept[:, None], _unit_length(sums), centres)
    return centres


def _vectors(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All vectors of a batch of sets as unit rows, and where each set begins (and the last ends)."""
    starts = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy())])
    inner = column.flatten()
    width = len(inner[0]) if len(inner) else 0
    return _unit_length(inner.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width or 1)), starts


def probed(sets: DataFrame, centres: np.ndarray, probes: int) -> DataFrame:
    """``set_id, vectors, lists, home``: the ``probes`` centroids nearest to each vector of a set, once
    each, and the one that is nearest to most of them."""
    fields = [T.StructField("lists", T.ArrayType(T.IntegerType())), T.StructField("home", T.IntegerType())]
    schema = T.StructType([sets.schema["set_id"], sets.schema["vectors"], *fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, starts = _vectors(batch.column(1))
            if not len(vectors):
                continue
            near = np.argsort(-(vectors @ centres.T), axis=1, kind="stable")[:, :probes]
            pairs = list(zip(starts, starts[1:]))
            lists = [np.unique(near[a:b]) for a, b in pairs]
            homes = [np.bincount(near[a:b, 0]).argmax() for a, b in pairs]
            ends = np.cumsum([0, *map(len, lists)])
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(lists), pa.int32()))
            columns = [batch.column(0), batch.column(1), listed, pa.array(homes, pa.int32())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return sets.select("set_id", "vectors").mapInArrow(run, schema)


def _marks(lists: pa.ListArray, width: int) -> np.ndarray:
    """A row per set with 1 at the places of its lists."""
    marks = np.zeros((len(lists), width), np.float32)
    marks[np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()] = 1
    return marks


class _Part:
    """The sets of a part; ``pieces`` hold names, unit vectors, sizes and marks of some of them each."""

    def __init__(self, pieces: list[tuple[list, np.ndarray, np.ndarray, np.ndarray]]):
        self.names = [name for piece in pieces for name in piece[0]]
        self.vectors, self.sizes, self.marks = (np.concatenate([piece[i] for piece in pieces]) for i in (1, 2, 3))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.order = np.array(self.names)
        self.places: dict = {}
        for i, name in enumerate(self.names):
            self.places.setdefault(name, []).append(i)
        self.repeats = max(map(len, self.places.values()))
        # of sets with the same vectors, the first
        firsts: dict = {}
        spans = zip(self.starts, self.starts + self.sizes)
        self.like = np.array([firsts.setdefault(self.vectors[a:b].tobytes(), i) for i, (a, b) in enumerate(spans)])
        # the first vectors of some sets, their second ones and so on, long sets first
        self.blocks = []
        for first in range(0, len(self.names), COLUMNS):
            members = first + np.argsort(-self.sizes[first : first + COLUMNS], kind="stable")
            counts = [np.count_nonzero(self.sizes[members] > j) for j in range(self.sizes[members[0]])]
            planes = [self.vectors[self.starts[members[:n]] + j].astype(np.float32).T for j, n in enumerate(counts)]
            self.blocks.append((members, planes))

    def rough(self, vectors: np.ndarray, starts: np.ndarray, sizes: np.ndarray, may: np.ndarray | None) -> np.ndarray:
        """Scores of some queries with all sets in single precision; minus infinity where not ``may``."""
        own = vectors.astype(np.float32)
        scores = np.full((len(sizes), len(self.names)), -np.inf, np.float32)
        for members, planes in self.blocks:
            if may is not None and not may[:, members].any():
                continue
            best = own @ planes[0]
            for plane in planes[1:]:
                some = best[:, : plane.shape[1]]
                np.maximum(some, own @ plane, out=some)
            scores[:, members] = np.add.reduceat(best, starts, axis=0) / sizes[:, None].astype(np.float32)
        scores[np.isnan(scores)] = -4  # after all numbers, as when sorted
        if may is not None:
            scores[~may] = -np.inf
        return scores

    def exact(self, own: np.ndarray, members: np.ndarray) -> np.ndarray:
        """Scores of a query with some sets."""
        sizes = self.sizes[members]
        places = np.cumsum(sizes) - sizes
        rows = np.repeat(self.starts[members] - places, sizes) + np.arange(sizes.sum())
        return np.maximum.reduceat(own @ self.vectors[rows].T, places, axis=1).mean(axis=0).round(6)

    def best(self, names: list, vectors: np.ndarray, sizes: np.ndarray, marks: np.ndarray, k: int) -> Iterator[tuple]:
        """``query, set, score`` of the ``k`` best sets for each of some queries."""
        starts = np.cumsum(sizes) - sizes
        may = marks @ self.marks.T > 0 if marks.shape[1] else None
        scores = self.rough(vectors, starts, sizes, may)
        for i, name in enumerate(names):
            scores[i, self.places.get(name, [])] = -np.inf
        # two errors of unit vectors' products and of the mean, and the rounding
        margin = 2 * (vectors.shape[1] + sizes.max() + 4) * 2.0**-23 + 1e-6
        worst = max(len(self.names) - k * self.repeats, 0)
        least = np.maximum(np.partition(scores, worst, axis=1)[:, worst] - margin, -5)
        for i, name in enumerate(names):
            members = np.flatnonzero(scores[i] >= least[i])
            if not len(members):
                continue
            distinct, which = np.unique(self.like[members], return_inverse=True)
            exact = self.exact(vectors[starts[i] : starts[i] + sizes[i]], distinct)[which]
            chosen: dict = {}
            for j in np.lexsort((self.order[members], -exact)).tolist():
                chosen.setdefault(self.names[members[j]], float(exact[j]))
                if len(chosen) == k:
                    break
            yield from ((name, other, score) for other, score in chosen.items())


def _chunks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of queries with about ``QUERY_VECTORS`` vectors, at least one each."""
    first, ends = 0, np.cumsum(sizes)
    while first < len(sizes):
        after = ends[first] - sizes[first] + QUERY_VECTORS
        last = max(int(np.searchsorted(ends, after, "right")), first + 1)
        yield first, last
        first = last


def maxsim_topk(
    queries: DataFrame, sets: DataFrame, k: int = 5, centroids: int = CENTROIDS, probes: int = PROBES, part: int = LIST_PART
) -> DataFrame:
    """``query_id, rank, set_id, maxsim``: the ``k`` candidate sets most similar to each query.

    ``queries`` and ``sets`` hold ``set_id, vectors``; a query never meets the set of its
    own id. Ties go to the lesser ``set_id``. Sets without vectors or id take no part; a vector of no
    length has cosine 0 with all. ``probes >= centroids`` searches everything.
    """
    usable = F.size(F.filter("vectors", lambda v: v.isNotNull() & ~F.exists(v, lambda x: x.isNull()))) == F.size("vectors")
    filled = (F.size("vectors") > 0) & usable
    queries, sets = queries.filter(filled).select("set_id", "vectors"), sets.filter(filled).select("set_id", "vectors")
    centres = fit_centroids(sets, centroids)
    own = sets.schema["set_id"]
    schema = T.StructType([T.StructField("query_id", own.dataType), own, T.StructField("maxsim", T.DoubleType())])
    queries, sets = queries.filter("set_id is not null"), sets.filter("set_id is not null")
    # a row per centroid, whatever the input
    listed = materialise(probed(sets, centres, 1), "lists") if len(centres) else None
    homes = listed.groupBy("home").agg(F.count(F.lit(1)), F.sum(F.size("vectors"))).orderBy("home").collect() if listed else []
    if not homes:
        empty = queries.sparkSession.createDataFrame([], schema)
        return empty.select("query_id", F.lit(0).cast("bigint").alias("rank"), "set_id", "maxsim")
    complete, width = probes >= len(centres), len(centres)
    total = sum(n for _, n, _ in homes)
    parts = int(np.ceil(max(total, sum(n for *_, n in homes) / SET_SIZE) / part))
    asked = queries.count()
    blocks = max(-(-asked // QUERY_BLOCK), min(-(-asked // LEAST_BLOCK), -(-UNITS // parts)), 1)

    # sets of one home lie side by side, so few parts hold a list
    counts = dict.fromkeys(range(width), 0) | {home: n for home, n, _ in homes}
    begins = np.cumsum([0, *counts.values()])
    mixed = F.xxhash64("set_id", "vectors")
    share = F.pmod(mixed, F.lit(1 << 30)) / float(1 << 30)

    def of_home(values) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("home") + 1)

    place = F.floor((of_home(begins[:-1]) + share * of_home(counts.values())) * (parts / total))
    members = listed.withColumn("part", F.least(place, F.lit(parts - 1)).cast("int"))
    asking = probed(queries, centres, probes).withColumn("block", F.pmod(mixed, F.lit(blocks)).cast("int"))
    if complete:
        asking = asking.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    else:
        held = members.groupBy("part").agg(F.array_distinct(F.flatten(F.collect_set("lists"))).alias("held"))
        held = held.select("part", "held", F.explode("held").alias("centroid"))
        # once for each part, by the first list of those shared
        first = F.array_min(F.array_intersect("lists", "held")) == F.col("centroid")
        asking = asking.withColumn("centroid", F.explode("lists")).join(F.broadcast(held), "centroid").filter(first)
    members = members.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    unit = (F.col("part") * blocks + F.col("block")).alias("unit")
    rows = members.select(unit, F.lit(0).alias("tag"), "home", "set_id", "vectors", "lists").unionByName(
        asking.select(unit, F.lit(1).alias("tag"), "home", "set_id", "vectors", "lists")
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pieces, held = None, [], None
        for batch in batches:
            vectors, starts = _vectors(batch.column(4))
            sizes, names = np.diff(starts), batch.column(3).to_pylist()
            marks = np.zeros((len(names), 0), np.float32) if complete else _marks(batch.column(5), width)
            keys = [batch.column(c).to_numpy() for c in (0, 1)]
            cuts = np.flatnonzero((np.diff(keys[0]) != 0) | (np.diff(keys[1]) != 0)) + 1
            out: list[tuple] = []
            for a, b in zip([0, *cuts], [*cuts, len(names)]):
                if keys[0][a] != at:
                    at, pieces, held = keys[0][a], [], None
                if keys[1][a] == 0:
                    pieces.append((names[a:b], vectors[starts[a] : starts[b]], sizes[a:b], marks[a:b]))
                    continue
                if not pieces:  # a part that no set was hashed to
                    continue
                held = held or _Part(pieces)
                for c, d in _chunks(sizes[a:b]):
                    c, d = a + c, a + d
                    out += held.best(names[c:d], vectors[starts[c] : starts[d]], sizes[c:d], marks[c:d], k)
            columns = zip(*out) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    found = (
        rows.repartitionById(parts * blocks, F.col("unit"))
        .sortWithinPartitions("unit", "tag", "home", "set_id")
        .mapInArrow(run, schema)
        # an id may come more than once
        .groupBy("query_id", "set_id")
        .agg(r6(F.max("maxsim")).alias("maxsim"))
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("maxsim"), F.asc("set_id"))
    return (
        found.withColumn("rank", F.row_number().over(order).cast("bigint"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "set_id", "maxsim")
    )


def recall(found: DataFrame, exact: DataFrame, least: float = 0.9) -> DataFrame:
    """``n_queries, n_exact, n_found, reached``: how many rows of ``exact`` are in ``found``."""
    met = exact.select("query_id", "set_id").join(
        found.select("query_id", "set_id", F.lit(1).alias("hit")), ["query_id", "set_id"], "left"
    )
    return met.agg(
        F.count_distinct("query_id").alias("n_queries"), F.count(F.lit(1)).alias("n_exact"), F.count("hit").alias("n_found")
    ).withColumn("reached", F.col("n_found") >= least * F.col("n_exact"))
