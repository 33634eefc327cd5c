"""Near-duplicates against brute force over all pairs."""

import random

import pytest

from optlake.llm import neardup as N

SMALL = "/root/testdata/sf0.001"


def brute(rows, size, percent):
    """{doc_id: (n_shingles, component, kept)} by comparing all pairs."""
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(N.shingle_set(t, size))
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and any(p and q and 100 * len(p & q) >= percent * len(p | q) for p in sets[x] for q in sets[y]):
                a, b = sorted((root(x), root(y)))
                parent[b] = a
    return {i: root(i) for i in ids}


def check(df, rows, scratch, size=2, percent=80):
    got = N.near_duplicates(df, scratch, size, percent).collect()
    want = brute(rows, size, percent)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept) == (want[r.doc_id], want[r.doc_id] == r.doc_id), r
    assert sorted(r.n_shingles for r in got) == sorted(len(N.shingle_set(t, size)) for _, t in rows)


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
    rows = list(enumerate([None, "", " \t\n", "one", "ONE", "one two", "One  Two", "one two three", long, long + " tail", "é É", "É é"]))
    rows += [(3, "one"), (None, "one"), (50, "one two")]
    check(docs(rows), rows, scratch)


def test_empty_table(docs, scratch):
    assert N.near_duplicates(docs([]), scratch).count() == 0


@pytest.mark.parametrize("size", [2, 5])
def test_planted_families(docs, scratch, size):
    rng = random.Random(5)
    texts = []
    for f in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(20, 200))]
        texts += family(rng, base, rng.randrange(1, 8), max(1, len(base) // 40)) + [" ".join(base)] * rng.randrange(1, 4)
    line = " ".join(f"c{i}" for i in range(14))
    texts += [line + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(2, 12))) for _ in range(60)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    check(docs(rows), rows, scratch, size)


@pytest.mark.parametrize("few,tile", [(1, 1 << 19), (1, 300), (10**9, 1)])
def test_unfinished_buckets_lose_no_link(docs, scratch, monkeypatch, few, tile):
    """A group whose copies are alike in pairs, not all: by pairs, by one tile, by many tiles."""
    monkeypatch.setattr(N, "FEW_PAIRS", few)
    monkeypatch.setattr(N, "TILE_OUTSIDE", tile)
    monkeypatch.setattr(N, "TILE_MEMBERS", 4 * tile)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(80)]
    rows = list(enumerate(family(rng, base, 60, 4)))
    check(docs(rows), rows, scratch)


def test_signature_distance_guarantee():
    """Signatures that differ in fewer than 2 * CHUNKS symbols always share a key."""
    import numpy as np

    rng, h = np.random.default_rng(1), N.Hasher(2)
    for _ in range(200):
        a = rng.integers(0, 65536, N.SYMBOLS).astype("<u2")
        b = a.copy()
        where = rng.choice(N.SYMBOLS, 2 * N.CHUNKS - 1, replace=False)
        b[where] ^= 1
        assert set(h.keys(a)) & set(h.keys(b))


def test_components_of_chains(llm, scratch):
    edges = [(i + 1, i) for i in range(40)] + [(100, 90), (100, 95), (95, 97)]
    got = {r.rep: r.component for r in N.components(llm.createDataFrame(edges, "a long, b long"), scratch).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 90 for i in (90, 95, 97, 100)}


def test_small_corpus(llm, scratch):
    df = llm.read.parquet(f"{SMALL}/documents.parquet")
    check(df, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], scratch)


def test_repeated_id_with_two_texts(docs, llm, scratch):
    """Each text of a repeated id is near another document; pairs are checked with the text of their own row."""
    one, two = [f"w{i}" for i in range(60)], [f"v{i}" for i in range(60)]
    texts = [(7, " ".join(one)), (7, " ".join(two)), (8, " ".join([*one[:-1], "x"])), (9, " ".join([*two[:-1], "x"]))]
    pairs = llm.createDataFrame([(7, 8), (7, 9)], "a long, b long").coalesce(1)
    frame = llm.createDataFrame(texts, "rep long, text string").coalesce(1)
    assert {tuple(r) for r in N.verify(pairs, frame, 2, 80).collect()} == {(7, 8), (7, 9)}
    check(docs(texts), texts, scratch)
