"""Language-model scores against a dictionary version."""

import math
from collections import Counter

import pytest

from optlake.llm import lm as M


def test_target_like_texts_score_higher(llm):
    from optlake.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    got = QUERIES["op3_lm_difference"](llm, sf)
    means = {r.quality: r.m for r in got.join(llm.read.parquet(f"{sf}/labels.parquet"), "doc_id").groupBy("quality").agg({"score": "avg"})
             .withColumnRenamed("avg(score)", "m").collect()}
    assert means[1] > means[0] and got.count() == 1000


def brute_words(rows, target):
    texts = [(i, M.tokens_of(t)) for i, t in rows]
    size = len({w for _, t in texts for w in t})
    out = [[i, len(t)] for i, t in texts]
    for wanted in (lambda i: i in target, lambda i: True):
        pairs, words = Counter(), Counter()
        for i, t in texts:
            if wanted(i):
                words.update(t)
                pairs.update(zip([None, *t], t))
        n, context = sum(words.values()), words | Counter({None: sum(wanted(i) and bool(t) for i, t in texts)})
        for (_, t), row in zip(texts, out):
            p = [(pairs[v, w] + M.BACKOFF * (words[w] + M.BACKOFF / size) / (n + M.BACKOFF)) / (context[v] + M.BACKOFF)
                 for v, w in zip([None, *t], t)]
            row.append(sum(-math.log2(x) for x in p) / max(1, len(t)))
    return [(*r, r[3] - r[2]) for r in out]


@pytest.mark.parametrize("tokens,docs_", [(M.BLOCK_TOKENS, M.BLOCK_DOCS), (7, 3)])
def test_words_against_dictionary(docs, llm, scratch, monkeypatch, tokens, docs_):
    monkeypatch.setattr(M, "BLOCK_TOKENS", tokens)
    monkeypatch.setattr(M, "BLOCK_DOCS", docs_)
    rows = [(0, "The cat sat on the mat."), (1, "ÉÉ the dog\n"), (2, None), (3, ""), (4, "zzzz zzz"), (5, "the cat"), (5, "the cat"),
            (6, "The cat sat. " * 800), (None, "no id"), (7, "猫坐在垫子上"), (8, "the mat the dog")]
    target = llm.createDataFrame([(0, 1), (5, 1), (5, 0), (None, 1), (99, 1)], "doc_id long, text int")
    got = sorted(map(tuple, M.score_by_words(docs(rows), target, scratch).collect()), key=lambda r: (r[0] is None, r[0] or 0))
    want = sorted(brute_words(rows, {0, 5}), key=lambda r: (r[0] is None, r[0] or 0))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:2] == w[:2] and all(abs(a - b) < 1e-9 for a, b in zip(g[2:], w[2:])), (g, w)
    assert M.score_by_words(docs([]), target, scratch).count() == 0


def test_query_tells_texts_outside_the_frequent_characters_apart(docs, llm, tmp_path):
    """Latin text leads; the wanted Chinese texts differ from the others by their words only."""
    from optlake.llm.queries import QUERIES

    latin = "".join(map(chr, range(97, 123))) + "0123456789.,;:!?-'()[]{}<>/\\|@#$%^&*_+=~"
    rows = [(i, latin * 5) for i in range(20)]
    rows += [(100 + i, ("猫坐在垫子" if i % 2 else "狗跑过田野") * 5) for i in range(40)]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    llm.createDataFrame([(100 + i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    score = {r.doc_id: r.score for r in QUERIES["op3_lm_difference"](llm, str(tmp_path)).collect()}
    assert min(score[i] for i in range(121, 140, 2)) > max(score[i] for i in range(120, 140, 2)) + 1
