"""Toxicity by class-conditional Kneser-Ney bigram models.

A toxic and an ordinary model are counted on a bounded sample of labelled
documents.  Bigrams are discounted and interpolated with the class's
continuation counts; those take pseudo-counts from a backoff that both classes
share: a word's first letters, split between the classes as all words that
start so are, and at last the classes' sizes.  A rare expression so falls back
on its stem, and one without a known stem says nothing.

A text's evidence is the length-normalised difference of the log-likelihoods
over the whole text and over its most toxic ``WINDOW`` words, and the sum of
what single words say beyond ``STRONG``.  A logistic curve, fitted on the part
of the sample kept out of the counts, makes a score of the three.

Scoring is a map over the corpus with the model broadcast; the model's size is
bounded by the sample.  Defined results: null and empty texts have no evidence
and get the curve's base score.  A sample without both classes scores every
text 0.  Repeated rows score alike; columns other than id and text are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from optlake.llm.common import Scratch, map_columns, words_of

#: Labelled documents of each class in the sample, at most.
SAMPLE_DOCS = 3000
#: Sampled documents a word must occur in; others are the unknown word 0.
MIN_DOCS = 3
#: Kneser-Ney discount; pseudo-counts of the shared backoff for a word and for a bigram's context.
DISCOUNT, BACKOFF, CONTEXT_BACKOFF = 0.75, 10.0, 1000.0
#: Bytes of a word's start; words of a window; a strong difference; folds of the held-out split.
START, WINDOW, STRONG, FOLDS = 5, 32, 1.5, 5
#: One in so many sampled documents fits the curve instead of the counts.
CURVE_SHARE = 4
UNKNOWN, BEGIN = 0, 1


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % FOLDS == 0


def _start(word: bytes) -> bytes:
    return b"^" + word[:START]  # no word holds "^"


def word_ids(text: str | None, vocab: dict) -> np.ndarray:
    """Ids of a text's words: their own, else that of their start, else UNKNOWN."""
    get = vocab.get
    return np.array([get(w) or get(_start(w), UNKNOWN) for w in words_of(text)], dtype=np.int64)


class Model:
    """Log-likelihood differences (toxic minus ordinary) of words, and what seen bigrams add; the curve."""

    def __init__(self, vocab, word, context, keys, extra, curve=(0.0, 0.0, 0.0, -30.0)):
        self.vocab, self.word, self.context, self.keys, self.extra, self.curve = vocab, word, context, keys, extra, curve

    def state(self) -> tuple:
        """Plain data to broadcast; ``Model(*state)`` rebuilds it in a task."""
        return self.vocab, self.word, self.context, self.keys, self.extra, self.curve

    def evidence(self, texts: list) -> np.ndarray:
        """(mean difference of the whole text, largest mean of a window, strong evidence) for each text."""
        n = len(self.word)
        out = np.zeros((len(texts), 3))
        for i, text in enumerate(texts):
            ids = word_ids(text, self.vocab)
            if not len(ids):
                continue
            before = np.concatenate(([BEGIN], ids[:-1]))
            alone = self.word[ids]
            diff = alone + self.context[before]
            known = np.flatnonzero((ids > BEGIN) & (before > UNKNOWN))
            if len(known) and len(self.keys):
                want = before[known] * n + ids[known]
                at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
                hit = self.keys[at] == want
                diff[known[hit]] += self.extra[at[hit]]
            total = np.concatenate(([0.0], np.cumsum(diff)))
            w = min(WINDOW, len(ids))
            out[i] = (total[-1] / len(ids), (total[w:] - total[:-w]).max() / w,
                      np.log1p(np.maximum(alone - STRONG, 0).sum()))
        return out

    def score(self, texts: list) -> np.ndarray:
        z = self.evidence(texts) @ np.array(self.curve[:3]) + self.curve[3]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Weighted ridge-penalised logistic regression on standardised columns, by Newton steps."""
    mid, wide = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mid) / wide, np.ones(len(x))])
    beta, ridge = np.zeros(z.shape[1]), np.eye(z.shape[1]) * 1e-2 * weight.mean()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        grad = z.T @ (weight * (y - p)) - ridge @ beta
        step = np.linalg.solve((z.T * (weight * p * (1 - p) + 1e-9)) @ z + ridge, grad)
        step *= min(1.0, 3.0 / max(1e-9, np.abs(step).max()))
        beta += step
        if np.abs(step).max() < 1e-7:
            break
    slope = beta[:-1] / wide
    return (*map(float, slope), float(beta[-1] - slope @ mid))


def _tables(counted: DataFrame, vocab: dict) -> Model:
    """Model from bigram counts (toxic, u, w, n), summed by Spark."""
    size = len(vocab) + 2
    ctx, kinds, cont = np.zeros((2, size)), np.zeros((2, size)), np.zeros((2, size))
    for r in counted.groupBy("toxic", "u").agg(F.sum("n").alias("c"), F.count("*").alias("k")).toLocalIterator():
        ctx[r.toxic, r.u], kinds[r.toxic, r.u] = r.c, r.k
    for r in counted.groupBy("toxic", "w").agg(F.count("*").alias("k")).toLocalIterator():
        cont[r.toxic, r.w] = r.k
    stem = np.arange(size)  # a word's start, or itself
    for w, i in vocab.items():
        if w[:1] != b"^":
            stem[i] = vocab.get(_start(w), i)
    total = np.maximum(cont.sum(1, keepdims=True), 1)
    stems = np.zeros((2, size))
    for k in (0, 1):
        np.add.at(stems[k], stem, cont[k])
    shared = (stems + BACKOFF * total / total.sum()) / (stems.sum(0) + BACKOFF)  # the classes' shares of a start
    mass = np.maximum(cont - DISCOUNT, 0) + (BACKOFF + DISCOUNT) * shared[:, stem]
    word = np.log(mass[1] / mass[0] * total[0] / total[1])
    uni = mass / mass.sum(1, keepdims=True)
    seen = (counted.where((F.col("u") > UNKNOWN) & (F.col("w") > BEGIN)).groupBy("u", "w")
            .agg(F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("n0"),
                 F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("n1"))
            .where(F.col("n0") + F.col("n1") >= 2).toPandas())
    u, w = seen["u"].to_numpy(np.int64), seen["w"].to_numpy(np.int64)
    room = (DISCOUNT * kinds + CONTEXT_BACKOFF) / (ctx + CONTEXT_BACKOFF)  # what a context leaves to the continuation counts
    context = np.log(room[1] / room[0])
    p = [np.maximum(seen[f"n{k}"].to_numpy(float) - DISCOUNT, 0) / (ctx[k, u] + CONTEXT_BACKOFF) + room[k, u] * uni[k, w]
         for k in (0, 1)]
    extra = np.log(p[1] / p[0]) - word[w] - context[u]
    order = np.argsort(u * size + w)
    return Model(vocab, word, context, (u * size + w)[order], extra[order])


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Model of labelled documents; ``labels`` has the id column and toxic (0 or 1)."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1))
             .groupBy(id_col).agg(F.max("toxic").cast("int").alias("toxic"))
             .join(docs.select(id_col).distinct(), id_col, "left_semi"))
    order = F.xxhash64(F.lit("toxicity"), F.col(id_col))
    weight, picks = {}, None
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    for k in (0, 1):
        some = known.where(F.col("toxic") == k).orderBy(order, id_col).limit(SAMPLE_DOCS)
        picks = some if picks is None else picks.unionByName(some)
        weight[k] = counts.get(k, 0) / max(1, min(SAMPLE_DOCS, counts.get(k, 0)))
    if not (counts.get(0) and counts.get(1)):
        return Model({}, np.zeros(2), np.zeros(2), np.zeros(0, np.int64), np.zeros(0))  # scores 0
    picks = F.broadcast(picks)  # 2 * SAMPLE_DOCS ids at most
    sample = scratch.keep(
        docs.select(id_col, text_col).join(picks, id_col)
        .withColumn("curve", F.pmod(F.xxhash64(F.lit("curve"), F.col(id_col)), F.lit(CURVE_SHARE)) == 0), "toxic-sample")
    counted_docs = sample.where(~F.col("curve"))

    def distinct_words():
        def step(texts):
            sets = [set(words_of(t)) for t in texts]
            return [[list(s | {_start(w) for w in s}) for s in sets]]

        return step

    words = (map_columns(counted_docs, [text_col], "words array<binary>", distinct_words)
             .select(F.explode("words").alias("word")).groupBy("word").count().where(F.col("count") >= MIN_DOCS))
    vocab = {bytes(r.word): i + 2 for i, r in enumerate(words.orderBy("word").toLocalIterator())}
    n = len(vocab) + 2
    shared = scratch.spark.sparkContext.broadcast(vocab)

    def bigrams():
        known_words = shared.value

        def step(toxic, texts):
            keys = []
            for k, t in zip(toxic, texts):
                ids = word_ids(t, known_words)
                keys.append((k * n + np.concatenate(([BEGIN], ids[:-1]))[:len(ids)]) * n + ids)
            key, num = np.unique(np.concatenate(keys or [np.zeros(0, np.int64)]), return_counts=True)
            return [key // (n * n), key // n % n, key % n, num]

        return step

    counted = scratch.keep(
        map_columns(counted_docs, ["toxic", text_col], "toxic int, u int, w int, n long", bigrams)
        .groupBy("toxic", "u", "w").agg(F.sum("n").alias("n")), "toxic-bigrams")
    model = _tables(counted, vocab)
    scratch.drop(counted)

    state = scratch.spark.sparkContext.broadcast(model.state())

    def evidence():
        now = Model(*state.value)

        def step(toxic, texts):
            x = now.evidence(texts)
            return [toxic, *x.T]

        return step

    held = map_columns(sample.where("curve"), ["toxic", text_col], "toxic int, mean double, peak double, strong double", evidence).toPandas()
    y = held["toxic"].to_numpy(float)
    if 0 < y.sum() < len(y):
        model.curve = fit_curve(held[["mean", "peak", "strong"]].to_numpy(), y, np.where(y == 1, weight[1], weight[0]))
    else:  # too few documents for a curve: the sign of the evidence decides
        model.curve = (1.0, 1.0, 1.0, -1.0)
    scratch.drop(sample)
    return model


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                   keep: list[str] | None = None) -> DataFrame:
    """Score of every text (0 to 1), with the columns of ``keep`` (the id by default)."""
    state = docs.sparkSession.sparkContext.broadcast(model.state())
    keep = keep or [id_col]
    types = dict(docs.dtypes)

    def start():
        now = Model(*state.value)

        def step(*cols):
            return [*cols[:-1], now.score(cols[-1])]

        return step

    fields = ", ".join(f"`{c}` {types[c]}" for c in keep)
    return map_columns(docs, [*keep, F.col(text_col).alias("__text")], f"{fields}, score double", start)
