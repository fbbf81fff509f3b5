"""HyperMinHash near-duplicates against full comparison of all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from plumbline.llm import hyperminhash, queries
from plumbline.llm.common import table

DOCS = "doc_id long, text string"


def shingles(text, size=5):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def plain(rows):
    """``(doc_id, n_shingles, component_id)`` per row by comparing all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index = {}
    for i, s in enumerate(sets):
        for x in s:
            index.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in index[x] if j < i)
        for j, n in common.items():
            if 100 * n >= 85 * (len(s) + len(sets[j]) - n):
                parent[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return [(rows[i][0], len(s), least.get(top(i)) if s else rows[i][0]) for i, s in enumerate(sets)]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_registers_by_hand():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 5000):
        hashes = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        got = hyperminhash.registers(hashes)
        want = [0] * hyperminhash.BUCKETS
        least = {}
        for h in hashes.tolist():
            bucket = (h >> 32) * hyperminhash.BUCKETS >> 32
            least[bucket] = min(least.get(bucket, 1 << 32), h & 0xFFFFFFFF)
        for bucket, h in least.items():
            bits = f"{h:032b}"
            zeros = 32 - len(bits.lstrip("0"))
            want[bucket] = zeros + 1 << 10 | int((bits[zeros + 1 :] + "0" * 10)[:10], 2)
        assert got.tolist() == want


def test_estimates_are_near():
    rng = np.random.default_rng(2)
    for size, share in ((2000, 0.9), (2000, 0.5), (20_000, 0.85), (400, 0.0)):
        pool = np.unique(rng.integers(0, 1 << 64, 2 * size, dtype=np.uint64))
        off = []
        for _ in range(20):
            picked = rng.permutation(pool)[:size]
            both = int(share * size)
            rest = (size - both) // 2
            a, b = picked[: both + rest], np.concatenate([picked[:both], picked[both + rest :]])
            sketch = [hyperminhash.registers(np.sort(x))[None, :] for x in (a, b)]
            found, _ = hyperminhash.estimate(*sketch, np.array([float(len(a))]), np.array([float(len(b))]))
            off.append(found[0, 0] - both / size)
        assert abs(np.mean(off)) < 0.03 and np.max(np.abs(off)) < 0.15


def test_chance_agreement_is_counted():
    """Two unrelated sets agree in as many registers as the correction expects."""
    rng = np.random.default_rng(3)
    n, agree, trials = 3000, 0, 400
    for _ in range(trials):
        a, b = (hyperminhash.registers(np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))) for _ in range(2))
        agree += int((a == b).sum())
    odds = hyperminhash._zeros_odds(np.array([float(n)]))
    want = (odds @ odds.T)[0, 0] / 2.0**hyperminhash.MANTISSA * hyperminhash.BUCKETS * trials
    assert 0.5 * want < agree < 2 * want


def edited(pick, words, share):
    return " ".join(pick.choice("xyzw") + str(pick.randint(0, 9999)) if pick.random() < share else w for w in words)


def corpus(pick):
    vocabulary = [f"w{i}" for i in range(400)]
    rows, passage = [], " ".join(pick.choice(vocabulary) for _ in range(60))
    for size in (1, 2, 4, 5, 9, 30, 200, 1500):
        for _ in range(6):
            base = [pick.choice(vocabulary) for _ in range(size)]
            rows += [edited(pick, base, share) for share in (0, 0, 0.005, 0.01, 0.02, 0.03, 0.05)]
    hub = [pick.choice(vocabulary) for _ in range(300)]
    rows += [edited(pick, hub, 0.012) for _ in range(120)] + [" ".join(hub).upper()] * 40
    # a chain in which neighbours alone are alike
    chain = [pick.choice(vocabulary) for _ in range(200)]
    for i in range(0, 200, 10):
        chain[i] = f"c{i}"
        rows.append(" ".join(chain))
    rows += [passage + " " + " ".join(pick.choice(vocabulary) for _ in range(20)) for _ in range(60)]
    rows += [None, "", " \n\t", "é ß  日本", "é ß   日本", "a b c d", "A B\nC D", "a b c"]
    return rows


def test_like_all_pairs(spark):
    pick = random.Random(4)
    texts = corpus(pick)
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts, 1)] + [(3, "another text of the same id"), (3, texts[2])]
    pick.shuffle(rows)
    extra = ("node", "key", "ident", "salt", "unit", "side", "a", "b", "root", "component_id", "n_shingles", "registers")
    frame = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in extra})
    for sizes in ({}, {"unit": 7, "tile": 5}):
        got = hyperminhash.near_duplicates(frame, **sizes)
        assert ordered(tuple(r) for r in got.collect()) == ordered(plain(rows))


def test_query_and_empty_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    got = queries.op11_hyperminhash_near_dedup(spark, sf).collect()
    assert ordered(tuple(r)[:3] for r in got) == ordered(plain(rows))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert hyperminhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    assert hyperminhash.near_duplicates(spark.createDataFrame([(1, None), (2, "")], DOCS)).count() == 2


def test_bands_of_one_hub_are_taken_together(spark):
    """Each of 30 bands lacks some nodes of one group: its nodes come once per pair of tiles, and pairs of a band still meet."""
    name = lambda i: f"n{i:03d}".encode()
    members = {k: [i for i in range(100) if i % 30 != k % 30] for k in range(30)} | {90: [5, 200]}
    rows = [(k, name(i), b"hub") for k, found in members.items() for i in found] + [(k, b"hub", b"hub") for k in members]
    # bands that share a hub and no node are dearer together
    rows += [(100 + k, name(300 + 10 * k + i), b"far") for k in range(20) for i in range(10)]
    shared = spark.createDataFrame(rows, "key long, node binary, hub binary")
    roots = spark.createDataFrame([(name(1), name(0))], "node binary, root binary")
    units = {}
    for r in hyperminhash._tile_units(shared, roots, 10).collect():
        units.setdefault(r.unit, []).append((r.side, bytes(r.node), bytes(r.comp)))
    near = [u for u in units.values() if any(n < name(300) for _, n, _ in u)]
    assert sum(map(len, near)) <= 101 * 11
    met = set()
    for rows_ in units.values():
        for s, a, _ in rows_:
            met |= {frozenset((a, b)) for t, b, _ in rows_ if a != b and (s == t == 2 or {s, t} == {0, 1})}
    wanted = {frozenset((name(a), name(b))) for found in members.values() for a in found for b in found if a != b}
    wanted |= {frozenset((name(300 + 10 * k + i), name(300 + 10 * k + j))) for k in range(20) for i in range(10) for j in range(i)}
    assert wanted <= met
    assert sum(len(u) for u in units.values() if u not in near) <= 200 * 2
    assert {c for u in near for _, n, c in u if n == name(1)} == {name(0)}
