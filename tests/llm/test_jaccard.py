"""Exact Jaccard join against brute force over all pairs of shingle sets."""

import random

import numpy as np
import pytest

from optlake.llm import jaccard as J

SMALL = "/root/testdata/sf0.001"


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def brute(rows, size, percent):
    """{doc_id: smallest reachable id} by comparing all pairs."""
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t, size))
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, x in enumerate(ids):
        for y in ids[n + 1:]:
            if any(p & q and 100 * len(p & q) >= percent * len(p | q) for p in sets[x] for q in sets[y]):
                a, b = sorted((root(x), root(y)))
                parent[b] = a
    return {i: root(i) for i in ids}


def check(df, rows, scratch, size=5, percent=80):
    got = J.jaccard_join(df, scratch, size, percent).collect()
    want = brute(rows, size, percent)
    assert sorted((str(r.doc_id), r.n_shingles) for r in got) == sorted((str(i), len(shingles(t, size))) for i, t in rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert all(r.component_id is None for r in got if r.doc_id is None)


def family(rng, base, copies, edits):
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(edits):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_edge_cases(docs, scratch):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = list(enumerate([None, "", " \t\n", "one", "ONE", "one two", "a b c d E", "A  b\x0bc d e", "a b c d e f", long, long + " tail", "é É", "É é"]))
    rows += [(3, "one"), (None, "one"), (50, "one two"), (9, long)]
    check(docs(rows), rows, scratch)
    check(docs([]), [], scratch)


@pytest.mark.parametrize("size,percent", [(5, 80), (2, 80), (3, 60)])
def test_planted_families(docs, scratch, size, percent):
    rng = random.Random(5)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(20, 200))]
        texts += family(rng, base, rng.randrange(1, 8), max(1, len(base) // 60)) + [" ".join(base)] * rng.randrange(1, 4)
        texts.append(" ".join(base[:len(base) * 85 // 100]))  # a shorter copy
    line = " ".join(f"c{i}" for i in range(14))
    texts += [line + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(2, 12))) for _ in range(60)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    check(docs(rows), rows, scratch, size, percent)


@pytest.mark.parametrize("tile,group,listed", [(2048, 8192, 1 << 18), (7, 5, 0)])
def test_unfinished_groups_lose_no_link(docs, scratch, monkeypatch, tile, group, listed):
    """Copies that are alike in pairs, not all; one tile or many, whole groups or parts, with common shingles listed or not."""
    monkeypatch.setattr(J, "TILE_ROWS", tile)
    monkeypatch.setattr(J, "GROUP_ROWS", group)
    monkeypatch.setattr(J, "LISTED", listed)
    rng = random.Random(8)
    texts = family(rng, [f"w{i}" for i in range(80)], 70, 1) + family(rng, [f"v{i}" for i in range(300)], 40, 5)
    rows = list(enumerate(texts))
    check(docs(rows), rows, scratch)


def test_bound_is_from_above():
    """Bit counts never say less than the true overlap, at any mix of widths."""
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, n, replace=False)) for n in (1, 2, 15, 16, 17, 40, 100, 300, 900, 2500)]
    for x in sets:
        for y in sets:
            a, b = (np.frombuffer(J.bitmap(s), np.uint64)[None, :] for s in (x, y))
            width = min(a.shape[1], b.shape[1])
            m, n = np.array([len(x)]), np.array([len(y)])
            bound = J.overlap_bound(J.fold_to(a, width), J.fold_to(b, width), m, n)[0, 0]
            assert bound >= len(np.intersect1d(x, y)) and bound == J.pair_bound(J.bitmap(x), J.bitmap(y), len(x), len(y))
    alike = np.concatenate([sets[6][:-1], [np.uint64(7)]])
    far = np.unique(rng.integers(0, 2**63, 100).astype(np.uint64))
    need = J.needed(np.array([100]), np.array([100]), 80)[0]
    bound = [J.overlap_bound(*(np.frombuffer(J.bitmap(s), np.uint64)[None, :] for s in (sets[6], o)), np.array([100]), np.array([100]))[0, 0]
             for o in (alike, far)]
    assert need == 89 and bound[0] >= 99 and bound[1] < need


def test_keys_are_complete():
    """Two sets at the similarity share a key in any order of shingles."""
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randrange(1, 60)
        x = rng.sample(range(200), n)
        y = x[:]
        while True:
            z = y[:]
            z[rng.randrange(len(z))] = rng.randrange(200, 10**6)
            if rng.random() < 0.3 and len(z) > 1:
                z.pop()
            if 100 * len(set(x) & set(z)) < 80 * len(set(x) | set(z)):
                break
            y = z
        listed = np.array(rng.sample(range(200), 20), np.uint64)
        order = J.Order(listed)
        first = [set(order.first(np.array(sorted(set(s)), np.uint64), J.key_count(len(set(s)), 80)).tolist()) for s in (x, y)]
        assert first[0] & first[1]


def test_small_corpus(llm, scratch):
    df = llm.read.parquet(f"{SMALL}/documents.parquet")
    check(df, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], scratch)


def test_repeated_id_with_two_texts(docs, scratch):
    one, two = [f"w{i}" for i in range(60)], [f"v{i}" for i in range(60)]
    texts = [(7, " ".join(one)), (7, " ".join(two)), (8, " ".join([*one[:-1], "x"])), (9, " ".join([*two[:-1], "x"]))]
    check(docs(texts), texts, scratch)
