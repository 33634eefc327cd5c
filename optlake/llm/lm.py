"""Language-model scores by cross-entropy difference.

A target model (documents labelled as wanted) and a background model (all
documents) are word-bigram models.  They are matched: one vocabulary, one order,
one smoothing; the vocabulary is every word of the corpus.  A text's score is
the mean, over its tokens, of background loss minus target loss in bits: the
higher, the more it looks like the target.

Defined results: null and empty texts have no tokens, losses and score 0; very
long texts are read whole.  Without target documents the target model is
uniform.  A document that is labelled several times is a target if any label
says so; a repeated row is counted and scored again.  An empty table gives no
rows.  Columns other than id and text are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from optlake.llm.common import Scratch, broadcast_if_few, map_stream, words_of

#: Pseudo-counts of the lower order.
BACKOFF = 20.0
#: Least parts the n-grams are dealt into (a power of two), n-grams of a part, tokens and documents of a block.
PARTS, PART_GRAMS, BLOCK_TOKENS, BLOCK_DOCS = 256, 1 << 22, 1 << 20, 20_000
#: Characters of scripts without blanks are words of their own.
_ALONE = re.compile("[฀-໿က-႟ក-៿⺀-鿿豈-﫿\U00020000-\U0003ffff]")
_START = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(text: str | None) -> list[bytes]:
    """Lower-cased words of a whole text."""
    text = (text or "").lower()
    return words_of(text if text.isascii() else _ALONE.sub(r" \g<0> ", text))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, byte plane by byte plane, compressed."""
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() for a in arrays]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpack(blob: bytes, n: int, *types: str) -> list[np.ndarray]:
    """The arrays that ``pack`` was given."""
    wide = [np.dtype(t).itemsize for t in types]
    raw = np.frombuffer(pa.decompress(blob, n * sum(wide), codec="zstd", asbytes=True), np.uint8)
    ends = np.cumsum([0, *wide]) * n
    return [np.ascontiguousarray(raw[a:b].reshape(w, n).T).view(t).reshape(n) for a, b, w, t in zip(ends, ends[1:], wide, types)]


class Grams:
    """Distinct n-grams of a block, bigrams and words, by key."""

    def __init__(self, words: np.ndarray, tokens: np.ndarray, sizes: np.ndarray):
        n = len(words)
        before = np.empty(len(tokens), np.int64)
        before[1:] = tokens[:-1]
        first = (np.cumsum(sizes) - sizes)[sizes > 0]
        before[first] = n  # the start of a text
        code, self.of_token = np.unique(before * (n + 1) + tokens, return_inverse=True)
        self.before, self.word = code // (n + 1), code % (n + 1)
        self.pairs = len(code)
        h = np.append(words, _START)
        kinds = [_mix(_mix(h[self.before]) + h[self.word]), _mix(words)]
        keys = np.concatenate([k & ~np.uint64(1) | np.uint64(i) for i, k in enumerate(kinds)])
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def counts(self, tokens: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Weighted counts by key."""
        words = len(self.keys) - self.pairs
        parts = [np.bincount(self.of_token, weight, self.pairs), np.bincount(tokens, weight, words)]
        return np.concatenate(parts)[self.order].astype(np.int64)


def word_blocks(flagged: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents packed into blocks: ids, sizes and whether wanted of its documents, its words (hashes) and tokens."""
    def start(rows):
        block = TaskContext.get().partitionId() << 32
        ids, wanted, sizes, words, tokens = [], [], [], {}, []

        def packed():
            hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
            return block, ids, wanted, sizes, len(hashes), pack(hashes), len(tokens), pack(np.array(tokens, np.int32))

        for i, text, w in rows:
            got = tokens_of(text)
            ids.append(i)
            wanted.append(int(bool(w)))
            sizes.append(len(got))
            tokens += [words.setdefault(x, len(words)) for x in got]
            if len(tokens) >= BLOCK_TOKENS or len(ids) >= BLOCK_DOCS:
                yield packed()
                block += 1
                ids, wanted, sizes, words, tokens = [], [], [], {}, []
        if ids:
            yield packed()

    return map_stream(flagged, [id_col, text_col, "__t"], "block long, ids array<long>, wanted array<int>, sizes array<int>, "
                      "n_words long, words binary, n_tokens long, tokens binary", start, 1)


def _block(wanted, sizes, n_words, words, n_tokens, tokens):
    """Grams of a block, its tokens, and per token its document and 1 if that is wanted."""
    (words,), (tokens,) = unpack(words, n_words, "u8"), unpack(tokens, n_tokens, "i4")
    tokens, sizes = tokens.astype(np.int64), np.array(sizes, np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    return Grams(words, tokens, sizes), tokens, doc, np.array(wanted, np.int64)[doc]


def score_by_words(docs: DataFrame, target: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) by word bigrams of the whole corpus.

    One shared vocabulary holds every word of every document.  Each block of
    documents sends its distinct n-grams with target and background counts to
    the part of the n-gram table that their key falls into, gets the sums back
    and scores its own documents; so a hot n-gram has a row per block, and
    nothing is capped, collected or broadcast.  N-grams are known by 62-bit
    hashes.  The bigram is interpolated with the word, the word with uniform; a
    context's count includes the texts that end in it.
    """
    wanted = broadcast_if_few(target.where(F.col(id_col).isNotNull()).select(id_col).distinct()).withColumn("__t", F.lit(True))
    blocks = scratch.keep(word_blocks(docs.join(wanted, id_col, "left"), id_col, text_col), "lm-blocks")
    held = F.arrays_zip("sizes", "wanted")

    def over(value):  # sum over the documents of a block
        return F.sum(F.aggregate(held, F.lit(0).cast("long"), lambda s, x: s + value(x)))

    total = blocks.agg(over(lambda x: x.sizes).alias("b"), over(lambda x: x.sizes * x.wanted).alias("t"),
                       over(lambda x: (x.sizes > 0).cast("int")).alias("b_texts"),
                       over(lambda x: (x.sizes > 0).cast("int") * x.wanted).alias("t_texts")).first()  # one row
    totals = {"target": (total.t or 0, total.t_texts or 0), "background": (total.b or 0, total.b_texts or 0)}
    bits = max(PARTS, 1 << (2 * (total.b or 0) // PART_GRAMS).bit_length()).bit_length() - 1
    content = ["wanted", "sizes", "n_words", "words", "n_tokens", "tokens"]

    def deal(rows):
        for block, *rest in rows:
            g, tokens, _, flag = _block(*rest)
            t, b = (g.counts(tokens, w).astype(np.int64) for w in (flag, np.ones(len(tokens))))
            cut = np.searchsorted(g.keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).tolist()
            for part, (x, y) in enumerate(zip(cut, cut[1:])):
                if y > x:  # keys as differences, which are smaller
                    yield part, block, y - x, pack(np.diff(g.keys[x:y], prepend=np.uint64(0)), t[x:y], b[x:y])

    dealt = map_stream(blocks, ["block", *content], "part int, block long, n int, grams binary", deal, 200)
    struct = _parse_datatype_string("block long, part int, words long, n int, sums binary")
    schema = to_arrow_schema(struct)

    def add(rows: pa.Table) -> pa.Table:
        sizes = rows["n"].to_pylist()
        got = [unpack(blob, n, "u8", "i8", "i8") for blob, n in zip(rows["grams"].to_pylist(), sizes)]
        keys, of_key = np.unique(np.concatenate([np.cumsum(k, dtype=np.uint64) for k, _, _ in got]), return_inverse=True)
        words = np.zeros(rows.num_rows, np.int64)
        words[0] = np.count_nonzero(keys & np.uint64(1))
        t, b = (np.bincount(of_key, np.concatenate([x[c] for x in got]), len(keys)).astype(np.int64)[of_key] for c in (1, 2))
        ends = np.cumsum([0, *sizes]).tolist()
        cols = [rows["block"].to_pylist(), rows["part"].to_pylist(), words, sizes, [pack(t[x:y], b[x:y]) for x, y in zip(ends, ends[1:])]]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    summed = scratch.keep(dealt.groupBy("part").applyInArrow(add, struct), "lm-sums")
    distinct = max(1, summed.agg(F.sum("words")).first()[0] or 0)
    result = _parse_datatype_string(f"`{id_col}` long, n_tokens long, target_loss double, background_loss double, score double")
    out_schema = to_arrow_schema(result)

    def score(block: pa.Table, sums: pa.Table) -> pa.Table:
        if not block.num_rows:
            return out_schema.empty_table()
        ids, sizes = block["ids"][0].as_py(), np.array(block["sizes"][0].as_py(), np.int64)
        g, _, doc, _ = _block(*(block[c][0].as_py() for c in content))
        sums = sums.sort_by("part")
        got = [unpack(blob, n, "i8", "i8") for blob, n in zip(sums["sums"].to_pylist(), sums["n"].to_pylist())]
        losses_ = []
        for c, (n, texts) in enumerate(totals.values()):
            mean = np.zeros(len(ids))
            if len(doc):
                count = np.empty(len(g.keys))
                count[g.order] = np.concatenate([x[c] for x in got])
                pair, word = count[:g.pairs], count[g.pairs:]
                p = (word + BACKOFF / distinct) / (n + BACKOFF)
                p = (pair + BACKOFF * p[g.word]) / (np.append(word, texts)[g.before] + BACKOFF)
                mean = np.bincount(doc, -np.log2(p)[g.of_token], len(ids)) / np.maximum(sizes, 1)
            losses_.append(mean)
        cols = [ids, sizes, *losses_, losses_[1] - losses_[0]]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out_schema)], schema=out_schema)

    return blocks.groupBy("block").cogroup(summed.drop("words").groupBy("block")).applyInArrow(score, result)
