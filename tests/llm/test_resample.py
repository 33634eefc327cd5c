"""Importance resampling against plain dictionaries and one global sort."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from optlake.llm import resample as R

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute(rows, target, least=20, percent=25):
    """Sorted (doc_id, n_features, weight, score, rank) by one sort over everything."""
    s, t = Counter(), Counter()
    for _, x in rows:
        s.update(features(x)[1])
    for x in target:
        t.update(features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    out, open_ = [], []
    for i, x in rows:
        words, f = features(x)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in f]
        weight = sum(gain) // len(f) if f else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        row = [i, len(f), weight, score, None]
        out.append(row)
        if i is not None and words >= least:
            open_.append(row)
    open_.sort(key=lambda r: (-r[3], r[0], r[1]))
    for n, row in enumerate(open_[:percent * len(open_) // 100]):
        row[4] = n + 1
    return key(map(tuple, out))


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def run(llm, scratch, df, target, **kw):
    frame = llm.createDataFrame([(n, x) for n, x in enumerate(target)], "item_id long, text string")
    return key(tuple(r) for r in R.resample(df, frame, scratch, **kw).collect())


def corpus(n, seed=4):
    r = random.Random(seed)
    vocab = ["of", "The", "and", "école", "ÀB", "x1", "naïve", "end.", "a-b", "日本"] + [f"w{k}" for k in range(300)]
    texts = [" ".join(r.choices(vocab, k=r.randrange(0, 60))) for _ in range(n)]
    return texts, [" ".join(r.choices(vocab[:40], k=30)) for _ in range(20)]


@pytest.mark.parametrize("rows,segment", [(1 << 18, 1 << 19), (7, 5)])
def test_random(docs, llm, scratch, monkeypatch, rows, segment):
    """Long and short runs, few and many segments."""
    monkeypatch.setattr(R, "RUN_ROWS", rows)
    monkeypatch.setattr(R, "SEGMENT_ROWS", segment)
    texts, target = corpus(400)
    given = list(enumerate(texts)) + [(7, texts[7])] * 60 + [(9, texts[8])] * 3 + [(None, texts[3]), (None, None)]
    assert run(llm, scratch, docs(given).repartition(5), target) == brute(given, target)


def test_edges(docs, llm, scratch):
    long = " ".join(f"w{i}" for i in range(40_000))
    given = [(1, None), (2, ""), (3, " .,! "), (4, "one"), (5, "a " * 19), (6, "A b " * 10), (7, long), (-8, "ä Ä " * 30), (8, "\0x\x7f" * 25)]
    assert run(llm, scratch, docs(given), ["w1 w2", None, ""]) == brute(given, ["w1 w2", None, ""])
    assert run(llm, scratch, docs(given), [], percent=100) == brute(given, [], percent=100)
    assert run(llm, scratch, docs(given), ["a"], least_words=0, percent=60) == brute(given, ["a"], least=0, percent=60)
    assert run(llm, scratch, docs([]), ["a"]) == []


def test_hashes_of_runs():
    words = "one two three two".split()
    grams = [" ".join(words[i:i + j]) for j in (1, 2, 3) for i in range(len(words) - j + 1)]
    assert R.feature_hashes([w.encode() for w in words], 3).tolist() == [zlib.crc32(g.encode()) for g in grams]
    assert R.feature_hashes([b"one"], 2).tolist() == [zlib.crc32(b"one")] and len(R.feature_hashes([])) == 0


def test_regular_samples_balance_segments(llm):
    """Splitters from runs of any order give segments of at most about twice their share."""
    r = np.random.default_rng(1)
    runs, segments = [], 16
    for k in range(20):
        score = np.sort(r.normal(k * 500, 3000, 4000).astype(int))[::-1]  # runs cover different ranges
        doc = np.arange(4000) + k * 4000
        runs.append((k, 4000, score.tolist(), doc.tolist(), [3] * 4000))
    frame = llm.createDataFrame(runs, "run long, n long, scores array<long>, ids array<long>, features array<long>")
    keys = R.splitters(frame, segments, len(runs))
    assert keys == sorted(keys) and len(keys) == segments - 1
    sizes = sum(np.diff(R.cuts(k, [np.array(a) for a in arrays], keys)) for k, _, *arrays in runs)
    assert sizes.sum() == 80_000 and sizes.max() <= 2 * 80_000 / segments + 20


def test_target_is_preferred(docs, llm, scratch):
    """Documents like the target are drawn more often than others."""
    r = random.Random(2)
    good, bad = [f"g{k}" for k in range(50)], [f"b{k}" for k in range(50)]
    texts = [" ".join(r.choices(good if k % 2 else bad, k=40)) for k in range(400)]
    got = run(llm, scratch, docs(texts), [" ".join(good)] * 30)
    drawn = [i for i, *_, rank in got if rank is not None]
    assert len(drawn) == 100 and sum(i % 2 for i in drawn) >= 70
