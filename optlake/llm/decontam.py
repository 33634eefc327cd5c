"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

1. Scan: one map over the corpus finds every word ``SEED``-gram of a test item
   (the items' words and grams are broadcast; benchmarks beyond ``MAX_WORDS``
   words are worked off in slices of items, each within that bound).  Hits on
   about one diagonal of an item become a passage: the words around them, as
   numbers of the benchmark's vocabulary (0: any other word).
2. Bound: an alignment matches at most the words that passage and item have in
   common (counted with repeats).  A passage whose common words cannot reach
   the least score is given up; how often a gram occurs decides nothing, so an
   item that leaked a thousand times, edited or not, is found each time, and
   stock phrases cost a count of words.
3. Align: the other passages are aligned with their item (match 2, mismatch
   and gap -1); the score is the alignment's share of a perfect one.

Text is read once and never shuffled; the passages are written to the shared
scratch folder, so lost executors re-read them.  Defined results: null and
empty texts, and items of fewer than ``SEED`` words, have no leaks; very long
texts are read whole; an empty table gives no rows; repeated items and rows that
share an id are one, rows without an id stay apart; a document that holds an item
several times has its best passage reported, the first of equals.  Columns other
than id and text are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from optlake.llm.common import Scratch, map_columns, map_stream, words_of

#: Words of a seed; words around a passage; least share of a perfect alignment; least aligned words.
SEED, SLACK, MIN_SCORE, MIN_WORDS = 3, 8, 0.5, 8
#: Words of the benchmark that are broadcast at once.
MAX_WORDS = 2_000_000
MATCH, MISS, GAP = 2, -1, -1


class Items:
    """Vocabulary, grams and postings of a slice of the benchmark."""

    def __init__(self, rows: list[tuple[int, list[bytes]]]):
        self.item_ids = [i for i, _ in rows]
        self.vocab: dict[bytes, int] = {}
        self.words = [np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in ws], dtype=np.int64) for _, ws in rows]
        self.base = len(self.vocab) + 1
        keys, item, pos = [], [], []
        for k, ws in enumerate(self.words):
            g = self.gram_keys(ws)
            keys.append(g)
            item.append(np.full(len(g), k))
            pos.append(np.arange(len(g)))
        empty = np.zeros(0, np.int64)
        keys, item, pos = (np.concatenate([empty, *a]).astype(np.int64) for a in (keys, item, pos))
        order = np.argsort(keys, kind="stable")
        self.keys, self.first = np.unique(keys[order], return_index=True)
        self.first = np.append(self.first, len(keys))
        self.item, self.pos = item[order], pos[order]

    def gram_keys(self, ids: np.ndarray) -> np.ndarray:
        """Keys of all grams; 0 where a word is unknown."""
        n = len(ids) - SEED + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        key, known = np.zeros(n, np.int64), np.ones(n, bool)
        for j in range(SEED):
            part = ids[j:j + n]
            key = key * self.base + part
            known &= part > 0
        return np.where(known, key, 0)

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, gram numbers) of the item grams of a text."""
        key = self.gram_keys(ids)
        at = np.flatnonzero(key)
        if not len(at) or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        g = np.minimum(np.searchsorted(self.keys, key[at]), len(self.keys) - 1)
        same = self.keys[g] == key[at]
        return at[same], g[same]

    def passages(self, at: np.ndarray, grams: np.ndarray, n: int) -> Iterator[tuple[int, int, int]]:
        """(item number, start, end) around the hits of a text of n words."""
        num = self.first[grams + 1] - self.first[grams]
        hit = np.repeat(np.arange(len(at)), num)
        posting = np.arange(num.sum()) + np.repeat(self.first[grams] - np.concatenate(([0], np.cumsum(num)[:-1])), num)
        item = self.item[posting]
        begin = at[hit] - self.pos[posting]
        order = np.lexsort((begin, item))
        now, lo, hi = -1, 0, 0
        for k, b in zip(item[order].tolist(), begin[order].tolist()):
            size = len(self.words[k])
            a, z = b - SLACK, b + size + SLACK
            if k == now and z - lo <= 2 * (size + 2 * SLACK):
                hi = max(hi, z)
                continue
            if now >= 0:
                yield now, max(0, lo), min(n, hi)
            now, lo, hi = k, a, z
        if now >= 0:
            yield now, max(0, lo), min(n, hi)

    def common(self, k: int, passage: list[int]) -> int:
        """Words that item k and a passage have in common, counted with repeats: no alignment matches more."""
        return (Counter(self.words[k].tolist()) & Counter(passage)).total()


def reaches(matched: float, size: int, min_score: float) -> bool:
    """Whether so many matched words (the score over MATCH) are a leak of an item of ``size`` words."""
    return matched / size >= min_score and matched >= min(MIN_WORDS, size)


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smith-Waterman of pairs: (best score, matched-word bound, end in the passage) for each pair."""
    n, rows = len(items), max(map(len, items), default=0)
    width = max(map(len, passages), default=0)
    a, b = np.full((n, rows), -1), np.full((n, width), -2)
    for i, (x, y) in enumerate(zip(items, passages)):
        a[i, :len(x)] = x
        b[i, :len(y)] = np.where(y > 0, y, -2)
    h = np.zeros((n, width + 1))
    best, end = np.zeros(n), np.zeros(n, np.int64)
    slide = GAP * np.arange(width + 1)
    for r in range(rows):
        step = np.where(a[:, r:r + 1] == b, MATCH, MISS)
        t = np.zeros_like(h)
        t[:, 1:] = np.maximum(h[:, :-1] + step, h[:, 1:] + GAP)
        t = np.maximum(t, 0)
        h = np.maximum.accumulate(t - slide, axis=1) + slide  # gaps along the passage
        top = h.max(1)
        better = top > best
        end[better] = h[better].argmax(1)
        best = np.maximum(best, top)
    return best, best / MATCH, end


def _slices(bench: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Items in slices of at most MAX_WORDS words (one item at least)."""
    held, total = [], 0
    rows = bench.where(F.col(id_col).isNotNull()).select(id_col, text_col).orderBy(id_col, text_col)
    for r in rows.toLocalIterator():
        words = words_of((r[1] or "").lower())
        if len(words) < SEED:
            continue
        if held and total + len(words) > MAX_WORDS:
            yield held
            held, total = [], 0
        held.append((r[0], words))
        total += len(words)
    if held:
        yield held


def find_leaks(docs: DataFrame, bench: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word): leaked items of every document."""
    spark = docs.sparkSession
    parts = [_leaks_of(docs, rows, scratch, id_col, text_col, min_score) for rows in _slices(bench, item_col, item_text)]
    out = parts[0] if parts else spark.createDataFrame(
        [], f"`{id_col}` long, item_id long, score double, start_word long, end_word long")
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _leaks_of(docs: DataFrame, rows: list, scratch: Scratch, id_col: str, text_col: str, min_score: float) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(rows)

    def scan(stream: Iterator[tuple]) -> Iterator[tuple]:
        from pyspark import TaskContext

        items, task = Items(shared.value), TaskContext.get().partitionId() << 32
        get = items.vocab.get
        for row, (doc, text) in enumerate(stream):
            apart = task + row + 1 if doc is None else 0  # tells rows without an id from each other
            ids = np.array([get(w, 0) for w in words_of((text or "").lower())], dtype=np.int64)
            at, grams = items.hits(ids)
            for k, a, z in items.passages(at, grams, len(ids)) if len(at) else ():
                words = ids[a:z].tolist()
                if reaches(items.common(k, words), len(items.words[k]), min_score):
                    yield doc, apart, k, a, z, words

    found = scratch.keep(map_stream(docs, [id_col, text_col], f"`{id_col}` long, apart long, item int, start int, stop int, words array<int>", scan),
                         "leak-passages")

    def score():
        known = Items(shared.value)

        def step(ids, apart, item, start, stop, words):
            out = [[], [], [], [], [], []]
            # pairs of like size are aligned together
            pick = sorted(range(len(ids)), key=lambda i: (len(known.words[item[i]]), len(words[i])))
            for j in range(0, len(pick), 256):
                some = pick[j:j + 256]
                targets = [known.words[item[i]] for i in some]
                best, bound, end = align(targets, [np.array(words[i]) for i in some])
                for i, t, s, m, e in zip(some, targets, best, bound, end):
                    if reaches(float(m), len(t), min_score):
                        last = start[i] + int(e)
                        row = (ids[i], apart[i], known.item_ids[item[i]], float(s) / (MATCH * len(t)), max(start[i], last - len(t)), last)
                        for c, v in zip(out, row):
                            c.append(v)
            return out

        return step

    cols = [id_col, "apart", "item", "start", "stop", "words"]
    scored = map_columns(found, cols,
                         f"`{id_col}` long, apart long, item_id long, score double, start_word long, end_word long", score)
    best = F.max(F.struct("score", (-F.col("start_word")).alias("s"), (-F.col("end_word")).alias("e"))).alias("best")
    return scored.groupBy(id_col, "apart", "item_id").agg(best).select(
        id_col, "item_id", "best.score", (-F.col("best.s")).alias("start_word"), (-F.col("best.e")).alias("end_word"))
