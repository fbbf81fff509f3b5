"""Late interaction by inverted lists against all pairs of sets."""

from __future__ import annotations

import numpy as np
import pytest

from plumbline.operators import late

SETS = "set_id long, vectors array<array<float>>"


def clustered(rng, n):
    """Sets of one to five vectors near a few directions, some repeated, one vector of no length."""
    centres = rng.normal(size=(10, 16))
    sets = [(centres[rng.integers(0, 10, rng.integers(1, 6))] + 0.3 * rng.normal(size=16)).astype(np.float32) for _ in range(n)]
    sets[3], sets[4] = sets[5], np.zeros((2, 16), np.float32)
    return [(i, s.tolist()) for i, s in enumerate(sets)]


def plain(queries, sets, k):
    def unit(v):
        v = np.array(v, np.float64)
        n = np.linalg.norm(v, axis=1, keepdims=True)
        return np.divide(v, n, out=np.zeros_like(v), where=n > 0)

    out = []
    for q, vectors in queries:
        scores = [(-round(float((unit(vectors) @ unit(s).T).max(axis=1).mean()), 6) + 0.0, i) for i, s in sets if i != q]
        out += [(q, rank, i, -score + 0.0) for rank, (score, i) in enumerate(sorted(scores)[:k], 1)]
    return out


@pytest.mark.parametrize("part", [3, 512])
def test_complete_lists_are_exact(spark, part):
    rows = clustered(np.random.default_rng(1), 70)
    sets = spark.createDataFrame(rows, SETS)
    got = late.maxsim_topk(sets, sets, k=4, centroids=6, probes=6, part=part)
    found = sorted((r.query_id, r["rank"], r.set_id, r.maxsim + 0.0) for r in got.collect())
    want = plain(rows, rows, 4)
    assert [f[:2] for f in found] == [w[:2] for w in want]
    assert np.allclose([f[3] for f in found], [w[3] for w in want], atol=2e-6)
    assert sum(f[2] == w[2] for f, w in zip(found, want)) >= len(want) - 4


def test_few_probes_find_most(spark):
    rows = clustered(np.random.default_rng(2), 300)
    sets = spark.createDataFrame(rows, SETS)
    exact = late.maxsim_topk(sets, sets, k=5, centroids=8, probes=8)
    some = late.maxsim_topk(sets, sets, k=5, centroids=8, probes=3)
    row = late.recall(some, exact).first()
    assert row.n_queries == 300 and row.n_exact == 1500 and row.reached


def test_odd_sets(spark):
    rows = [(1, [[1.0, 0.0]]), (2, None), (3, []), (4, [None, [1.0, 1.0]]), (5, [[None, 1.0]]), (6, [[0.0, 2.0], [3.0, 0.0]])]
    sets = spark.createDataFrame(rows, SETS)
    got = [tuple(r) for r in late.maxsim_topk(sets, sets, k=3).orderBy("query_id").collect()]
    assert got == [(1, 1, 6, 1.0), (6, 1, 1, 0.5)]
    none = spark.createDataFrame([], SETS)
    assert late.maxsim_topk(none, none).count() == 0 and late.maxsim_topk(sets, none).count() == 0


def test_a_set_is_placed_once_with_all_its_lists(spark):
    rows = clustered(np.random.default_rng(3), 40)
    centres = np.random.default_rng(4).normal(size=(6, 16))
    got = late.probed(spark.createDataFrame(rows, SETS), centres, 2).collect()
    assert sorted(r.set_id for r in got) == list(range(40))
    sets = dict(rows)
    for r in got:
        near = np.argsort(-(np.array(sets[r.set_id]) @ centres.T), axis=1, kind="stable")
        assert r.lists == sorted(set(near[:, :2].ravel().tolist())) and list(near[:, 0]).count(r.home) == np.bincount(near[:, 0]).max()


def test_scores_closer_than_single_precision(spark):
    """Near copies in several blocks of columns and chunks of queries."""
    rng = np.random.default_rng(5)
    base = [rng.normal(size=(rng.integers(1, 9), 16)) for _ in range(40)]
    rows = [(i, (base[i % 40] + 1e-4 * rng.normal(size=base[i % 40].shape)).tolist()) for i in range(400)]
    schema = "set_id long, vectors array<array<double>>"
    asked = rows[:120]
    sets = spark.createDataFrame(rows, schema)
    got = late.maxsim_topk(spark.createDataFrame(asked, schema), sets, k=4, centroids=6, probes=6)
    found = sorted((r.query_id, r["rank"], r.set_id, r.maxsim) for r in got.collect())
    want = plain(asked, rows, 4)
    assert [f[:2] for f in found] == [w[:2] for w in want]
    assert np.allclose([f[3] for f in found], [w[3] for w in want], atol=1.5e-6)
    assert sum(f[2] == w[2] for f, w in zip(found, want)) >= len(want) - 4


def test_an_id_that_repeats_takes_one_place(spark):
    near = [[[1.0, 0.01 * i]] for i in range(4)]
    rows = [(1, near[0])] * 5 + [(2, near[1]), (2, near[3]), (3, near[2]), (None, near[0]), (9, [[1.0, 0.0]])]
    sets = spark.createDataFrame(rows, SETS)
    asked = sets.filter("set_id = 9")
    got = late.maxsim_topk(asked, sets, k=2, centroids=1, probes=1).orderBy("rank").collect()
    assert [(r["rank"], r.set_id) for r in got] == [(1, 1), (2, 2)] and got[0].maxsim == 1.0


@pytest.mark.parametrize("part", [8, 4096])
def test_candidates_are_the_sets_of_probed_lists(spark, part):
    """However the sets are cut into parts."""
    rows = clustered(np.random.default_rng(6), 90)
    sets = spark.createDataFrame(rows, SETS)
    centres = late.fit_centroids(sets, 8)
    unit = {i: late._unit_length(np.array(v, np.float64)) for i, v in rows}
    near = {i: np.argsort(-(v @ centres.T), axis=1, kind="stable") for i, v in unit.items()}
    meets = {(q, i) for q in near for i in near if set(near[q][:, :2].ravel()) & set(near[i][:, 0])}
    want = [w[:2] for q, v in rows for w in plain([(q, v)], [r for r in rows if (q, r[0]) in meets], 3)]
    got = late.maxsim_topk(sets, sets, k=3, centroids=8, probes=2, part=part).collect()
    assert sorted((r.query_id, r["rank"]) for r in got) == want
    assert all((r.query_id, r.set_id) in meets for r in got)


def test_copies_are_scored_once(monkeypatch):
    rng = np.random.default_rng(7)
    kinds = [late._unit_length(rng.normal(size=(n, 16))) for n in (3, 1, 4)]
    rows = [(i, kinds[i % 3] if i % 50 else late._unit_length(rng.normal(size=(2, 16)))) for i in range(600)]
    sizes, none = np.array([len(v) for _, v in rows]), np.zeros((600, 0), np.float32)
    held = late._Part([([i for i, _ in rows], np.concatenate([v for _, v in rows]), sizes, none)])
    scored, exact = [], held.exact
    monkeypatch.setattr(held, "exact", lambda own, members: scored.append(len(members)) or exact(own, members))
    some = slice(0, 20)
    got = list(held.best([i for i, _ in rows[some]], np.concatenate([v for _, v in rows[some]]), sizes[some], none[some], 5))
    want = plain(rows[some], rows, 5)
    assert [(q, i) for q, i, _ in got] == [(q, i) for q, _, i, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want], atol=1.5e-6)
    assert len(scored) == 20 and max(scored) <= 15
