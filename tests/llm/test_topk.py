"""Exact top-k against brute force."""

import math
import random

import numpy as np
import pytest

from optlake.llm import topk as K

SCHEMA = "vec_id long, embedding array<float>, label int, id int, score double"


def brute(rows, k, every, scale=K.SCALE):
    """{query id: sorted (rank, id, score)}; every row asks and is asked for itself."""
    whole = [(i, [math.floor(np.float32(x).item() * scale) for x in v]) for i, v in rows
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for r, (q, v) in enumerate(whole):
        if q % every == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), i) for c, (i, w) in enumerate(whole) if c != r)
            out.setdefault(q, []).extend((n + 1, i, -x) for n, (x, i) in enumerate(s[:k]))
    return {q: sorted(v) for q, v in out.items()}


def run(llm, scratch, rows, k=10, every=100):
    df = llm.createDataFrame([(i, v, 1, 2, 0.5) for i, v in rows], SCHEMA)
    got = {}
    for r in K.top_k(df, scratch, k, every).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(v) for q, v in got.items()}


@pytest.mark.parametrize("block,group", [(8192, 16384), (60, 3)])
def test_random(llm, scratch, monkeypatch, block, group):
    monkeypatch.setattr(K, "BLOCK_ROWS", block)
    monkeypatch.setattr(K, "GROUP_ROWS", group)
    r = np.random.default_rng(3)
    rows = [(i, (r.standard_normal(8) ** 3).tolist()) for i in range(600)]
    rows[77] = (77, rows[500][1])  # ties
    rows += [(700 + i, rows[300][1]) for i in range(30)]
    rows += [(100, rows[5][1]), (100, rows[6][1])]  # a query's id, twice more
    assert run(llm, scratch, rows, every=50) == brute(rows, 10, 50)


def test_edges(llm, scratch):
    rows = [(0, [1.0, -1.0]), (1, [0.5, 2.0]), (2, None), (3, []), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (100, [0.0, 0.0]), (100, [0.0, 0.0]), (None, [1.0, 1.0]), (7, [1.0])]
    got = run(llm, scratch, rows)
    assert got == brute([r for r in rows if r[0] != 7], 10, 100)
    assert run(llm, scratch, []) == {} and run(llm, scratch, [(0, [1.0])]) == {}
    assert run(llm, scratch, [(0, None)]) == {}


def search(x, rows, k=10, floor=None):
    """nra_block over one block for the queries at ``rows``, next to the plain products."""
    ids, own = np.arange(len(x)), np.array(rows)
    found, stopped = K.nra_block(K.Lists(x), own, x[own], np.full(len(own), -np.inf) if floor is None else floor, k, ids)
    for r, (cols, s) in zip(rows, found):
        full = x @ x[r]
        full[r] = -np.inf
        want = np.lexsort((ids, -full))[:k]
        if floor is None:
            assert cols.tolist() == want.tolist() and s.tolist() == full[want].tolist()
    return found, stopped


def test_bounds_stop_early_and_stay_exact():
    """On peaked vectors reading stops long before the lists end; results are exact either way."""
    r = random.Random(1)
    x = np.array([[r.choice([0, 0, 0, 0, 1, 900]) * (1 + (i == j % 7)) for i in range(6)] for j in range(4000)], dtype=float)
    _, stopped = search(x, list(range(0, 4000, 400)), 5)
    assert (stopped < 1).mean() >= 0.5


def test_given_embeddings_stop_by_bounds():
    """On the given table, which has no structure to help, every query stops before its lists are read to the end."""
    import pyarrow.parquet as pq

    rows = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pylist()
    x = np.array([[math.floor(c * K.SCALE) for c in r["embedding"]] for r in rows], dtype=float)
    asked = [n for n, r in enumerate(rows) if r["vec_id"] % 100 == 0]
    _, stopped = search(x, asked)
    assert len(asked) == 20 and (stopped < 1).all(), sorted(stopped)


def test_carried_scores_stop_a_block_sooner():
    """The k-th score of earlier blocks is a bound from the start: a block that cannot reach it is left at the first depths."""
    r = np.random.default_rng(2)
    x = np.floor(100 * r.standard_normal((2000, 16)))
    rows = list(range(0, 2000, 100))
    _, plain = search(x, rows)
    top = np.array([np.sort(x @ x[q])[::-1][1] for q in rows]) * 3  # a score that nothing here reaches
    found, carried = search(x, rows, floor=top)
    assert carried.mean() < plain.mean() and (carried <= plain).all() and not any(len(c) for c, _ in found)
