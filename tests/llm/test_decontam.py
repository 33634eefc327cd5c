"""Decontamination: planted exact, edited and clean passages; alignment against a plain one."""

import random

import numpy as np

from optlake.llm import decontam as D
from optlake.llm.common import words_of


def plain_align(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1))
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            s = D.MATCH if x == y else D.MISS
            h[i, j] = max(0, h[i - 1, j - 1] + s, h[i - 1, j] + D.GAP, h[i, j - 1] + D.GAP)
    return h.max()


def test_alignment():
    r = np.random.default_rng(2)
    pairs = [(r.integers(1, 6, r.integers(1, 15)), r.integers(0, 6, r.integers(1, 25))) for _ in range(200)]
    best, _, _ = D.align([a for a, _ in pairs], [b for _, b in pairs])
    assert best.tolist() == [plain_align(a, [y or -2 for y in b]) for a, b in pairs]


def items_frame(llm, items):
    return llm.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, score int")


def planted():
    r = random.Random(4)
    vocab = [f"w{k}" for k in range(3000)] + ["the", "of", "and"] * 400
    def text(n):
        return [r.choice(vocab) for _ in range(n)]
    items = [(k, " ".join(text(r.randrange(12, 60)))) for k in range(30)]
    rows, want = [], set()
    for i in range(240):
        body, k = text(r.randrange(0, 300)), r.randrange(30)
        if i % 3 == 0:  # a copy, every other time edited
            copy = items[k][1].split()
            if i % 2:
                for _ in range(max(1, len(copy) // 10)):
                    copy[r.randrange(len(copy))] = "edit"
                copy.pop(r.randrange(len(copy)))
            at = r.randrange(len(body) + 1)
            body[at:at] = copy
            want.add((i, k))
        rows.append((i, ", ".join(body).upper() if i % 7 == 0 else " ".join(body)))
    return items, rows, want


def test_planted(docs, llm, scratch):
    items, rows, want = planted()
    got = {(r.doc_id, r.item_id): r for r in D.find_leaks(docs(rows), items_frame(llm, items), scratch).collect()}
    assert set(got) == want
    text, item = dict(rows), dict(items)
    for (i, k), r in got.items():
        found = words_of(text[i].lower())[r.start_word:r.end_word]
        assert len(set(found) & set(words_of(item[k]))) >= 0.7 * len(set(words_of(item[k])))


def test_common_leak_keeps_its_seeds(docs, llm, scratch):
    items, _, _ = planted()
    rows = [(i, f"copy {items[0][1]} {i}") for i in range(300)] + [(1000, "clean text of nothing")]
    got = D.find_leaks(docs(rows), items_frame(llm, items), scratch)
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(i, 0) for i in range(300)]


def test_common_edited_leak_is_found(docs, llm, scratch):
    """The edit breaks a third of the item's grams; the others are as common as the copies, next to a stock phrase."""
    item = [f"w{k}" for k in range(20)]
    copy = list(item)
    copy[5], copy[13] = "edit", "other"
    rows = [(i, f"{' '.join(copy)} tail {i}") for i in range(300)] + [(1000 + i, f"w0 w1 w2 {i} clean text") for i in range(50)]
    got = D.find_leaks(docs(rows), items_frame(llm, [(7, " ".join(item)), (8, "w0 w1 w2 " + " ".join(f"v{k}" for k in range(17)))]), scratch)
    assert sorted((r.doc_id, r.item_id, r.score) for r in got.collect()) == [(i, 7, 0.85) for i in range(300)]


def test_slices_and_edges(docs, llm, scratch, monkeypatch):
    items, rows, want = planted()
    monkeypatch.setattr(D, "MAX_WORDS", 100)
    more = items + [(90, None), (91, ""), (92, "two words"), (None, "the of and the of and the of and"), (0, items[0][1])]
    extra = rows + [(500, None), (501, ""), (502, items[1][1] + " x " + items[1][1]), (502, items[1][1])]
    extra += [(503, "pad " * 60_000 + items[2][1])]
    got = D.find_leaks(docs(extra), items_frame(llm, more), scratch).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want | {(502, 1), (503, 2)}
    assert D.find_leaks(docs([]), items_frame(llm, items), scratch).count() == 0
    assert D.find_leaks(docs(rows), items_frame(llm, []), scratch).count() == 0


def test_exact_copies_of_corpus(llm):
    from optlake.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    got = {(r.doc_id, r.item_id) for r in QUERIES["op8_decontaminate"](llm, sf).collect()}
    bench = llm.read.parquet(f"{sf}/benchmark.parquet").collect()
    text = llm.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    exact = {(r.doc_id, b.item_id) for r in text for b in bench if r.text and b.text in r.text}
    assert exact and exact <= got
    words = {r.doc_id: set(words_of((r.text or "").lower())) for r in text}
    item = {b.item_id: set(words_of(b.text.lower())) for b in bench}
    assert all(len(words[i] & item[k]) >= 0.5 * len(item[k]) for i, k in got)


def every_pair(rows, items):
    """{(doc_id, item_id)}: Smith-Waterman of every whole text with every item, without seeds, passages or bounds."""
    known = D.Items([(k, words_of(t.lower())) for k, t in items])
    out = set()
    for i, text in rows:
        ids = np.array([known.vocab.get(w, 0) for w in words_of((text or "").lower())], np.int64)
        if len(ids):
            best, matched, _ = D.align(known.words, [ids] * len(known.words))
            out |= {(i, known.item_ids[n]) for n, m in enumerate(matched) if D.reaches(float(m), len(known.words[n]), D.MIN_SCORE)}
    return out


def test_every_pair_of_the_small_corpus(llm, docs, scratch):
    """The whole query against all alignments: at sf0.001 nothing is missed and nothing is added."""
    from optlake.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = {(r.doc_id, r.item_id) for r in QUERIES["op8_decontaminate"](llm, sf).collect()}
    rows = [(r.doc_id, r.text) for r in llm.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in llm.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert got and got == every_pair(rows, items)


def test_recall_of_edited_leaks(docs, llm, scratch):
    """Copies with 5 to 35 % of their words changed: found are 98 % and more of those that all alignments give, and no others."""
    r = random.Random(12)
    vocab = [f"w{k}" for k in range(2000)] + ["the", "of"] * 200
    items = [(k, " ".join(r.choice(vocab) for _ in range(r.randrange(15, 60)))) for k in range(25)]
    rows = []
    for i in range(300):
        copy = items[i % 25][1].split()
        for _ in range(int(len(copy) * r.uniform(0.05, 0.35))):
            at = r.randrange(len(copy))
            copy[at:at + 1] = r.choice([["edit"], [], [copy[at], "more"]])
        pad = [[r.choice(vocab) for _ in range(r.randrange(0, 120))] for _ in range(2)]
        rows.append((i, " ".join(pad[0] + copy + pad[1])))
    want = every_pair(rows, items)
    got = {(x.doc_id, x.item_id) for x in D.find_leaks(docs(rows), items_frame(llm, items), scratch).collect()}
    assert got <= want and len(want) > 200 and len(got) >= 0.98 * len(want), (len(got), len(want))


def test_rows_without_an_id_stay_apart(docs, llm, scratch):
    items, _, _ = planted()
    rows = [(None, f"a {items[0][1]}"), (None, f"b c {items[0][1]}"), (4, items[0][1]), (4, f"x {items[0][1]}")]
    got = D.find_leaks(docs(rows), items_frame(llm, items), scratch).collect()
    assert sorted(str(r.doc_id) for r in got) == ["4", "None", "None"]
