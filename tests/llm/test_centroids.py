"""Centroid clustering against plain Lloyd rounds over all vectors."""

import hashlib
import heapq
import math

import numpy as np
import pytest

from optlake.llm import centroids as C

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, block int, id int, distance double"


def brute(rows, k=40, rounds=5, dim=64, scale=256, seed=2):
    """{(vec_id, vector): (cluster, distance)} and the final centroids, in Python integers."""
    kept = [(i, [math.floor(float(np.float32(x)) * scale) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    cents = [v for _, v in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        cents = [[sum(col) // len(groups[n]) for col in zip(*groups[n])] if n in groups else c for n, c in enumerate(cents)]
    return sorted((str(i), tuple(nearest(v)[::-1])) for i, v in kept), cents


def run(llm, scratch, rows, **kw):
    df = llm.createDataFrame([(i, v, 1, "c", 2, 3, 0.5) for i, v in rows], SCHEMA).repartition(3)
    found = C.cluster(df, scratch, **kw)
    return sorted((str(r.vec_id), (r.cluster, r.distance)) for r in found.rows.collect()), found


def clustered(n, dim, groups, seed=1, spread=0.05):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(groups, dim))
    return [(i, (centre[i % groups] + spread * r.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("block,spread", [(4096, 0.05), (37, 1.0)])
def test_random(llm, scratch, monkeypatch, block, spread):
    monkeypatch.setattr(C, "BLOCK_ROWS", block)
    rows = clustered(500, 8, 6, spread=spread) + [(3, [0.0] * 8)] * 20 + [(1000 + i, [0.25] * 8) for i in range(30)]
    got, found = run(llm, scratch, rows, k=7, dim=8)
    want, cents = brute(rows, 7, dim=8)
    assert got == want and found.centroids.tolist() == cents


def test_ties_and_edges(llm, scratch):
    """Equal distances, repeated ids with other vectors, null ids, wrong lengths, nulls and non-finite components."""
    rows = [(i, [float(i % 4), float(i // 4 % 4)]) for i in range(64)] + [(5, [9.0, 9.0]), (None, [1.5, 1.5]), (7, None), (8, []),
            (9, [1.0]), (10, [1.0, None]), (11, [float("nan"), 1.0]), (12, [1.0, float("inf")]), (13, [-0.001, 0.001])]
    got, _ = run(llm, scratch, rows, k=6, dim=2, scale=1)
    assert got == brute(rows, 6, dim=2, scale=1)[0]
    assert run(llm, scratch, rows[:2], k=6, dim=2)[0] == brute(rows[:2], 6, dim=2)[0]
    for none in ([], [(1, None)], [(None, [1.0, 2.0])]):
        assert run(llm, scratch, none, dim=2)[0] == []
    large = [(i, [100_000.0 * (i % 5), float(i)]) for i in range(40)]
    assert run(llm, scratch, large, k=4, dim=2)[0] == brute(large, 4, dim=2)[0]


def test_only_expired_gaps_are_scanned(llm, scratch):
    """On separated groups the heaps keep almost all vectors from being scanned again; results stay exact."""
    rows = clustered(2000, 16, 10, spread=0.02)
    got, found = run(llm, scratch, rows, k=10, dim=16)
    want, _ = brute(rows, 10, dim=16)
    assert got == want
    assert found.scanned[0] == 2000 and sum(found.scanned[1:]) < 0.5 * 5 * 2000


def test_heaps_follow_keys():
    """Members are popped only when the accumulated drift reaches their key; an unpopped member's centroid is still the nearest."""
    r = np.random.default_rng(5)
    x = (100 * r.normal(size=(300, 4))).astype(np.int64)
    moves = C.Moves(x[:5].copy())
    heaps, sums, scans = C.rescan_block(x, None, moves)
    assert scans == 300 and sum(n for n, _ in sums.values()) == 300
    for step in range(6):
        moves = moves.to(moves.centroids + r.integers(-8, 9, size=(5, 4)))
        for h in heaps.values():
            assert all(h[i][0] <= h[j][0] for i in range(len(h)) for j in (2 * i + 1, 2 * i + 2) if j < len(h))
        kept = {m: c for c, h in heaps.items() for key, m in h if key > moves.drift[c]}
        heaps, _, scans = C.rescan_block(x, heaps, moves)
        assert scans == 300 - len(kept)
        want = C.distances(x, moves.centroids).argmin(1)
        assert all(want[m] == c for m, c in kept.items())
        assert {m: c for c, h in heaps.items() for _, m in h} == dict(enumerate(want.tolist()))
    assert C.pop_expired([(1.0, 4)], 0.5) == [] and heapq is not None


def test_inertia(llm, scratch):
    rows = clustered(120, 4, 3)
    df = llm.createDataFrame([(i, v, 1, "c", 2, 3, 0.5) for i, v in rows], SCHEMA)
    found = C.cluster(df, scratch, k=4, dim=4)
    got = C.with_inertia(found).collect()
    want, cents = brute(rows, 4, dim=4)
    per = {}
    for _, (c, d) in want:
        per[c] = per.get(c, 0) + d
    assert len(got) == 120
    for r in got:
        assert (r.cluster_inertia, r.inertia) == (per[r.cluster], sum(per.values()))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, cents[r.cluster])).encode()).hexdigest()
