"""Near-duplicates by HyperMinHash: compressed registers, bands, estimate, full check.

A shingle falls into one of ``BANDS * ROWS`` buckets. A bucket keeps its least hash as
the count of leading zeros and the ``MANTISSA`` bits after them, 16 bits in all. Equal
bands of ``ROWS`` registers make candidates; an estimate of the Jaccard similarity from
all registers, corrected for registers that agree by chance, rules out the hopeless; the
rest is confirmed on full shingle sets, so no link is wrong.

A pair at the threshold misses all bands with probability ``(1 - 0.85 ** ROWS) ** BANDS``,
7e-9, and falls below the estimate's margin of six deviations with 1e-8. No bucket,
partner or candidate is capped.

Equal sets are one node. Pairs are not listed: the nodes of a band meet its hub, the node
that shares most, and are confirmed against it in slots of ``UNIT`` nodes. Bands whose
nodes are then still in several components are compared in tiles of ``TILE`` by ``TILE``
registers, those of one hub together, and only nodes with a hopeful partner in another
component bring their sets.
Tasks report forests. Where very many texts are alike by less than the threshold, tiles
grow with the square of their number: that is the price of losing no link.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from xxhash import xxh3_128_digest, xxh64_intdigest

from plumbline.llm.common import SALTS, map_rows, min_by_group, salt, with_group_min
from plumbline.llm.components import components
from plumbline.session import materialise

BANDS, ROWS = 32, 5
BUCKETS = BANDS * ROWS
MANTISSA = 10
DEVIATIONS = 6.0
UNIT = 1000
TILE = 256
BLOCK = 1 << 21
SEED = 42


def shingle_hashes(text: str | None, shingle: int = 5) -> tuple[int, np.ndarray]:
    """The number of distinct shingles of a text and their sorted 64-bit hashes.

    A-Z is lower-cased, ASCII white space splits words; fewer words than ``shingle`` are
    one shingle; no word or null text gives none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0, np.zeros(0, np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    last = max(0, len(words) - shingle)
    cuts = map(slice, (ends - lengths)[: last + 1].tolist(), ends[len(words) - last - 1 :].tolist())
    distinct = set(map(joined.__getitem__, cuts))
    hashes = np.fromiter(map(xxh64_intdigest, distinct, repeat(SEED)), np.uint64, len(distinct))
    return len(distinct), np.unique(hashes)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The compressed registers of a set: 0 for an empty bucket."""
    out = np.zeros(BUCKETS, np.uint16)
    if not len(hashes):
        return out
    bucket = (hashes >> np.uint64(32)) * np.uint64(BUCKETS) >> np.uint64(32)
    keyed = np.sort(bucket << np.uint64(32) | hashes & np.uint64(0xFFFFFFFF))
    bucket = (keyed >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    least = keyed[first] & np.uint64(0xFFFFFFFF)
    zeros = 32 - np.frexp(least.astype(np.float64))[1]
    after = (least << zeros.astype(np.uint64) & np.uint64(0x7FFFFFFF)) >> np.uint64(31 - MANTISSA)
    out[bucket[first]] = (zeros + 1 << MANTISSA) | after.astype(np.int64)
    return out


def _zeros_odds(n: np.ndarray) -> np.ndarray:
    """For sets of ``n`` elements: the odds that a bucket's least hash has so many leading zeros."""
    # a hash below 2 ** -z is missing from a bucket with exp(-n / BUCKETS * 2 ** -z)
    missing = np.exp(-n[:, None] / BUCKETS * 2.0 ** -np.arange(33)[None, :])
    return np.diff(missing, axis=1, append=1.0)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of all rows of registers ``a`` with all of ``b``, and the buckets they rest on.

    Registers that agree by chance are expected where the counts of zeros agree and
    one in ``2 ** MANTISSA`` mantissas does.
    """
    agree = np.zeros((len(a), len(b)), np.int32)
    empty = np.zeros_like(agree)
    blank_a, blank_b = a == 0, b == 0
    step = max(1, BLOCK // max(1, b.size))
    for i in range(0, len(a), step):
        part = slice(i, i + step)
        empty[part] = blank_a[part].astype(np.float32) @ blank_b.T.astype(np.float32)
        agree[part] = (a[part, None, :] == b[None, :, :]).sum(axis=2, dtype=np.uint8)
    agree -= empty
    used = BUCKETS - empty
    chance = _zeros_odds(n_a) @ _zeros_odds(n_b).T / 2.0**MANTISSA
    raw = agree / np.maximum(used, 1)
    return np.clip((raw - chance) / (1 - chance), 0, 1), used


def hopeful(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Pairs whose estimate does not rule out ``percent`` by ``DEVIATIONS`` standard deviations."""
    found, used = estimate(a, b, n_a, n_b)
    share = percent / 100
    return found >= share - DEVIATIONS * np.sqrt(share * (1 - share) / np.maximum(used, 1))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have ``100 * intersection >= percent * union``."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


SKETCH = [T.StructField("n_shingles", T.LongType()), T.StructField("node", T.BinaryType()), T.StructField("registers", T.BinaryType()), T.StructField("ident", T.LongType())]


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """``id_col, n_shingles, node, registers, ident`` per row; ``node`` is a digest of the set (null if empty)."""
    schema = T.StructType([docs.schema[id_col], *SKETCH])

    def step(ids, texts, idents):
        out = []
        for text in texts:
            n, hashes = shingle_hashes(text, shingle)
            out.append((n, xxh3_128_digest(hashes.tobytes()), registers(hashes).tobytes()) if n else (0, None, None))
        return [ids, *([row[i] for row in out] for i in range(3)), idents]

    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"), F.xxhash64(id_col, text_col).alias("_ident"))
    return map_rows(rows, [id_col, "_text", "_ident"], step, schema)


def _per_key(df: DataFrame, key: str, spread: str, salts: int = SALTS, **wanted: tuple[Callable, Column | int]) -> DataFrame:
    """``df`` with aggregates over the rows of the same ``key``, a hot key spread over ``salts`` tasks."""
    parts = df.groupBy(key, salt([spread], salts).alias("salt")).agg(*(f(F.lit(c)).alias(n) for n, (f, c) in wanted.items()))
    whole = Window.partitionBy(key)
    merged = parts.select(key, "salt", *(f(n).over(whole).alias(n) for n, (f, _) in wanted.items()))
    return df.withColumn("salt", salt([spread], salts)).join(merged, [key, "salt"]).drop("salt")


COUNT = (F.sum, 1)


def bands(nodes: DataFrame) -> DataFrame:
    """``key, node`` per band of ``nodes(node, registers)`` that is not empty."""
    size = 2 * ROWS
    parts = [F.substring("registers", 1 + size * i, size) for i in range(BANDS)]
    keys = [F.when(p != F.lit(bytes(size)), F.xxhash64(F.lit(i), p)) for i, p in enumerate(parts)]
    return nodes.select("node", F.explode(F.array(*keys)).alias("key")).filter("key is not null")


def _unit(*parts: Column) -> Column:
    return F.concat_ws("-", *(p.cast("string") for p in parts))


def _by_unit(rows: DataFrame, columns: list[str], schema: T.StructType, step: Callable) -> DataFrame:
    """``step(columns of a unit's rows as lists) -> output rows`` over units read as sorted streams."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[0] != now:
                    out += step(*map(list, zip(*held)))
                    held = []
                    if len(out) >= 1000:
                        yield _table(out, arrow)
                        out = []
                now = row[0]
                held.append(row)
        if held:
            out += step(*map(list, zip(*held)))
        yield _table(out, arrow)

    return rows.select("unit", *columns).repartition("unit").sortWithinPartitions("unit", "side", "node").mapInArrow(run, schema)


def _table(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(arrow)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)


def _to_compare(sides: list[int], comps: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and columns of a unit, and which of their pairs count: across sides, or all of one tile, between components."""
    sides, comp = np.array(sides), np.unique(np.array(comps, dtype=object), return_inverse=True)[1]
    own = sides[0] == 2
    left = np.flatnonzero(sides == (2 if own else 0))
    right = left if own else np.flatnonzero(sides == 1)
    pairs = comp[left][:, None] != comp[right][None, :]
    if own:
        pairs &= left[:, None] < right[None, :]
    return left, right, pairs


SURVIVORS = T.StructType([T.StructField("unit", T.StringType()), T.StructField("side", T.IntegerType()), T.StructField("node", T.BinaryType()), T.StructField("comp", T.BinaryType()), T.StructField("registers", T.BinaryType()), T.StructField("n_shingles", T.LongType())])
EDGES = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])


def _registers(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint16).reshape(len(values), BUCKETS)


def _hopes(sides, comps, sketched, sizes, percent) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    left, right, pairs = _to_compare(sides, comps)
    if pairs.any():
        held, n = _registers(sketched), np.array(sizes, np.float64)
        pairs &= hopeful(held[left], held[right], n[left], n[right], percent)
    return left, right, pairs


def confirm(units: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``a, b``: a forest of the confirmed links inside ``units(unit, side, node, comp)``.

    Rows of side 0 meet those of side 1; rows of side 2 meet each other. Nodes of one
    ``comp`` are not compared. Estimates come first; only nodes with a hopeful partner
    have their sets made from ``texts(node, text)``.
    """

    def survivors(unit, sides, found, comps, sketched, sizes):
        left, right, pairs = _hopes(sides, comps, sketched, sizes, percent)
        keep = sorted({*left[pairs.any(axis=1)].tolist(), *right[pairs.any(axis=0)].tolist()})
        return [(unit[i], sides[i], found[i], comps[i], sketched[i], sizes[i]) for i in keep]

    def edges(unit, sides, found, comps, sketched, sizes, sets):
        left, right, pairs = _hopes(sides, comps, sketched, sizes, percent)
        sets = [np.frombuffer(s, np.uint64) for s in sets]
        root = {c: c for c in comps}

        def top(c):
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        out = []
        for x, y in zip(*np.nonzero(pairs)):
            i, j = left[x], right[y]
            a, b = top(comps[i]), top(comps[j])
            if a != b and linked(sets[i], sets[j], percent):
                root[a] = b
                out.append((found[i], found[j]))
        return out

    known = units.join(nodes.select("node", "registers", "n_shingles"), "node")
    kept = materialise(_by_unit(known, ["side", "node", "comp", "registers", "n_shingles"], SURVIVORS, survivors), "hopeful")
    needed = texts.join(kept.select("node").distinct(), "node")
    made = map_rows(
        needed,
        ["node", "text"],
        lambda found, held: (found, [shingle_hashes(t, shingle)[1].tobytes() for t in held]),
        T.StructType([T.StructField("node", T.BinaryType()), T.StructField("hashes", T.BinaryType())]),
    )
    return _by_unit(kept.join(made, "node"), ["side", "node", "comp", "registers", "n_shingles", "hashes"], EDGES, edges)


def _star_units(shared: DataFrame, unit: int) -> DataFrame:
    """Every node with the hub of each of its bands, in slots of about ``unit`` nodes."""
    star = shared.filter("node != hub").select("node", "hub").distinct()
    slot = F.pmod(F.xxhash64("node"), F.ceil(F.col("degree") / unit))
    placed = _per_key(star, "hub", "node", degree=COUNT).select("node", "hub", _unit(F.hex("hub"), slot).alias("unit"))
    members = placed.select("unit", F.lit(1).alias("side"), "node", F.col("node").alias("comp"))
    hubs = placed.select("unit", F.col("hub").alias("node")).distinct()
    return members.union(hubs.select("unit", F.lit(0).alias("side"), "node", F.col("node").alias("comp")))


def _tile_units(shared: DataFrame, roots: DataFrame, tile: int) -> DataFrame:
    """The nodes of bands that hold several components beside their hub, in pairs of tiles.

    Bands of the same nodes count once, and bands of one hub, which mostly hold the same
    nodes, are taken together where that makes fewer rows. All have met the hub already.
    """
    labelled = shared.filter("node != hub").join(roots, "node", "left").select("key", "hub", "node", F.coalesce("root", "node").alias("comp"))
    mixed = _per_key(
        labelled,
        "key",
        "node",
        size=COUNT,
        low=(F.min, F.col("comp")),
        high=(F.max, F.col("comp")),
        x=(F.bit_xor, F.xxhash64("node")),
        y=(F.bit_xor, F.xxhash64("node", F.lit(1))),
    ).filter("low != high")
    once = with_group_min(mixed.withColumn("same", _unit(F.col("size"), F.col("x"), F.col("y"))), "same", "key", "least_key", ["node"])
    first = F.row_number().over(Window.partitionBy("hub", "node").orderBy("key")) == 1
    placed = materialise(
        once.filter("key = least_key").select("key", "hub", "node", "comp", "size", first.alias("first")), "mixed"
    )
    parts = F.ceil(F.col("size") / tile).cast("int")
    by_hub = _per_key(placed, "hub", "node", whole=(F.sum, F.col("first").cast("bigint")), apart=(F.sum, parts))
    together = F.col("whole") * F.ceil(F.col("whole") / tile) <= F.col("apart")
    mine, other = F.pmod(F.xxhash64("node", F.lit(2)), F.col("parts")).cast("int"), F.col("other")
    rows = (
        by_hub.withColumn("together", together)
        .filter("first or not together")
        .withColumn("group", F.when(F.col("together"), F.hex("hub")).otherwise(F.col("key").cast("string")))
        .withColumn("size", F.when(F.col("together"), F.col("whole")).otherwise(F.col("size")))
        .withColumn("parts", parts)
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    )
    side = F.when(F.col("mine") == other, 2).when(F.col("mine") < other, 0).otherwise(1)
    unit = _unit(F.col("group"), F.least("mine", "other"), F.greatest("mine", "other"))
    return rows.select(unit.alias("unit"), side.alias("side"), "node", "comp")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 85,
    unit: int = UNIT,
    tile: int = TILE,
) -> DataFrame:
    """``id_col, n_shingles, component_id`` per row of ``docs``.

    Rows link when ``100 * intersection >= percent * union`` of their sets of distinct
    shingles; ``component_id`` is the least id that a row reaches, its own included (null
    only if every row it reaches has a null id). Null texts and texts without a word have
    an empty set and link with nothing. Rows that repeat an id are rows of their own;
    equal sets are linked. An empty table gives an empty table.
    """
    found = materialise(sketches(docs, id_col, text_col, shingle), "sketches")
    filled = found.filter("node is not null")
    least = materialise(min_by_group(filled, "node", id_col, [id_col]), "least")
    nodes = materialise(
        filled.groupBy("node").agg(F.min("ident").alias("ident"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")),
        "nodes",
    )
    sized = _per_key(bands(nodes), "key", "node", size=COUNT).filter("size > 1").select("key", "node", "size")
    crowded = materialise(sized, "bands")
    weights = crowded.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = _per_key(crowded.join(weights, "node"), "key", "node", best=(F.max, F.struct("weight", "node")))
    shared = materialise(hubs.select("key", "node", F.col("best.node").alias("hub")), "shared")

    wanted = shared.select("node").distinct().join(nodes.select("node", "ident"), "node")
    whole = docs.select(F.xxhash64(id_col, text_col).alias("ident"), F.col(text_col).alias("text"))
    texts = whole.join(wanted, "ident")
    # another text of the same hash is told by its digest
    same = map_rows(
        texts,
        ["node", "text"],
        lambda names, held: (names, [t if xxh3_128_digest(shingle_hashes(t, shingle)[1].tobytes()) == n else None for n, t in zip(names, held)]),
        T.StructType([T.StructField("node", T.BinaryType()), T.StructField("text", T.StringType())]),
    )
    texts = materialise(same.filter("text is not null").dropDuplicates(["node"]), "texts")

    star = materialise(confirm(_star_units(shared, unit), nodes, texts, shingle, percent), "star")
    roots = components(star)
    rest = materialise(confirm(_tile_units(shared, roots, tile), nodes, texts, shingle, percent), "rest")
    roots = components(star.union(rest))

    rooted = materialise(
        least.groupBy("node")
        .agg(F.min("group_min").alias("least_id"))
        .join(roots, "node", "left")
        .select("node", "least_id", F.coalesce("root", "node").alias("root")),
        "rooted",
    )
    by_node = with_group_min(rooted, "root", "least_id", "component_id", ["node"]).select("node", "component_id")
    by_part = least.select("node", "salt").join(by_node, "node")
    named = filled.withColumn("salt", salt([id_col])).join(by_part, ["node", "salt"])
    alone = found.filter("node is null").select(F.col(id_col), "n_shingles", F.col(id_col).alias("component_id"))
    return named.select(F.col(id_col), "n_shingles", "component_id").union(alone)
