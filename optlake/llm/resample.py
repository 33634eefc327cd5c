"""Importance resampling towards a target distribution.

1. Buckets: the features of a text are its runs of 1 to ``LONGEST`` words; the
   CRC-32 of a run picks one of ``BUCKETS`` counters.  All documents (the source)
   and all target texts are counted, each task into one array.
2. Scores: a bucket's gain compares the two smoothed shares.  The gains are one
   array of fixed size; a document's weight is the floored mean over its
   features, its score adds Gumbel noise hashed from its id.  The highest scores
   are a sample without replacement in proportion to the weights.
3. Parallel sorting by regular sampling: a task sorts its scored rows into runs
   of at most RUN_ROWS.  Each run gives rows at regular places; the sorted
   samples give splitters.  Every run is cut at the splitters by binary search,
   counts of the cuts give each segment's first rank.  Only the segments that
   hold drawn ranks are exchanged; each merges its runs' pieces and numbers them.

The order is (score falling, id, number of features, run), so rows that share an
id are dealt over segments by run.  With as many samples a run as there are
segments (up to SAMPLE_ROWS in all, then fewer, at places shifted from run to
run) a segment holds at most about twice its share.  The driver sees the
counters, the samples and one count a segment.

Defined results: null and empty texts have no features and weight 0; very long
texts are read whole.  Rows without an id count as source but have a null score
and are never drawn.  Repeated rows are drawn one by one.  An empty target gives
every bucket the gain of its own rarity; an empty table gives no rows.  Columns
other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from optlake.llm.common import Scratch, fold_partition, map_stream, words_of

BUCKETS, LONGEST = 10_000, 2
LEAST_WORDS, PERCENT, SEED = 20, 25, 7
#: Rows of a sorted run, rows of a segment (about), samples that come to the driver.
RUN_ROWS, SEGMENT_ROWS, SAMPLE_ROWS = 1 << 18, 1 << 19, 1 << 20
ROWS = "doc_id long, n_features long, weight long, score long, rank long"
#: Columns of a run, one array each.
ARRAYS = ["scores", "ids", "features", "weights"]


def feature_hashes(words: list[bytes], longest: int = LONGEST) -> np.ndarray:
    """CRC-32 of every run of 1 to ``longest`` words joined by one space, repeats included."""
    now = [crc32(w) for w in words]
    found = [now]
    for j in range(1, min(longest, len(words))):
        now = [crc32(w, crc32(b" ", c)) for c, w in zip(now, words[j:])]
        found.append(now)
    return np.fromiter(chain.from_iterable(found), np.int64, sum(map(len, found)))


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features of all texts by bucket."""
    def fold(batches: Iterator[list[list]]) -> list:
        total = np.zeros(buckets, np.int64)
        for (column,) in batches:
            for text in column:
                total += np.bincount(feature_hashes(words_of(text), longest) % buckets, minlength=buckets)
        used = np.flatnonzero(total)
        return [used, total[used]]

    found = fold_partition(texts, [text_col], "bucket int, n long", fold).groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(buckets, np.int64)
    total[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return total


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of the smoothed shares) by bucket."""
    k, every_s, every_t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (every_s + k) / ((s + 1) * (every_t + k))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: int, seed: int = SEED) -> int:
    """Thousandths of Gumbel noise, a function of seed and id."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored_runs(docs: DataFrame, gains: np.ndarray, id_col: str, text_col: str, least: int, longest: int, seed: int) -> DataFrame:
    """(run, open, n, scores, ids, features, weights): sorted runs of the rows that may be drawn, and the others (not open)."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def start(rows: Iterator[tuple]) -> Iterator[tuple]:
        from pyspark import TaskContext

        gain, run = shared.value, TaskContext.get().partitionId() << 32
        held: dict[bool, list[tuple]] = {True: [], False: []}

        def pack(open_: bool):
            columns = list(zip(*held[open_]))
            if open_:
                score, doc, features, _ = order = [np.array(c, np.int64) for c in columns]
                place = np.lexsort((features, doc, -score))
                columns = [c[place] for c in order]
            return run, open_, len(columns[0]), *columns

        for doc, text in rows:
            words = words_of(text)
            at = feature_hashes(words, longest) % len(gain)
            weight = int(gain[at].sum()) // len(at) if len(at) else 0
            score = None if doc is None else weight + noise(doc, seed)
            group = doc is not None and len(words) >= least
            held[group].append((score, doc, len(at), weight))
            if len(held[group]) >= RUN_ROWS:
                yield pack(group)
                held[group].clear()
                run += 1
        for group in held:
            if held[group]:
                yield pack(group)
                run += 1

    return map_stream(docs, [F.col(id_col).cast("long"), F.col(text_col)],
                      "run long, open boolean, n long, " + ", ".join(f"{c} array<long>" for c in ARRAYS), start, rows=1)


def splitters(runs: DataFrame, segments: int, n_runs: int) -> list[tuple]:
    """Keys (score negated, id, features, run) that part the order into about equal segments."""
    each = max(1, min(segments, SAMPLE_ROWS // max(n_runs, 1)))
    shift = F.pmod(F.xxhash64("run"), F.lit(1024)) / 1024

    def taken(i):
        at = F.floor((i + shift) * F.col("n") / each).cast("int")
        return F.struct(*[F.get(c, at).alias(c) for c in ARRAYS[:3]], "run")

    found = runs.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(each - 1)), taken)).alias("s")).select("s.*").toArrow()
    score, doc, features, run = (found[c].to_numpy() for c in found.column_names)
    place = np.lexsort((run, features, doc, -score))
    picked = place[np.arange(1, segments) * len(place) // segments] if len(place) else place
    return list(zip((-score[picked]).tolist(), doc[picked].tolist(), features[picked].tolist(), run[picked].tolist()))


def cuts(run: int, columns: list[np.ndarray], keys: list[tuple]) -> list[int]:
    """Where a sorted run is cut: the rows of segment k stand from cut k up to cut k + 1."""
    score, doc, features = columns[:3]
    places, n = [0], len(score)
    for key in keys:
        places.append(bisect_left(range(n), key, lo=places[-1],
                                  key=lambda i: (-score[i], doc[i], features[i], run)))
    return [*places, n]


def ranked(runs: DataFrame, percent: int) -> DataFrame:
    """Rows of all runs; the best ``percent`` of the open ones have their rank."""
    spark = runs.sparkSession
    open_ = runs.where("open")
    size = open_.agg(F.count("*").alias("runs"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    segments = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size.rows // SEGMENT_ROWS))
    keys = spark.sparkContext.broadcast(splitters(open_, segments, size.runs))
    columns = ["run", *ARRAYS]

    def pieces(rows: Iterator[tuple]) -> Iterator[tuple]:
        for run, *arrays in rows:
            arrays = [np.array(a, np.int64) for a in arrays]
            at = cuts(run, arrays, keys.value)
            for k in range(len(at) - 1):
                if at[k] < at[k + 1]:
                    yield k, run, *[a[at[k]:at[k + 1]] for a in arrays]

    def counted(rows: Iterator[tuple]) -> Iterator[tuple]:
        for k, _, scores, *_ in pieces(rows):
            yield k, len(scores)

    sums = map_stream(open_, columns, "segment int, n long", counted).groupBy("segment").agg(F.sum("n").alias("n")).collect()
    per = np.zeros(segments, np.int64)
    for r in sums:
        per[r.segment] = r.n
    first = np.concatenate(([0], np.cumsum(per)))  # rank before a segment
    drawn = percent * size.rows // 100
    last = int(np.searchsorted(first, drawn)) - 1  # last segment with a drawn rank

    struct = _parse_datatype_string(ROWS)
    out = to_arrow_schema(struct)

    def flat(scores, ids, features, weights, ranks) -> pa.Table:
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (ids, features, weights, scores, ranks)], schema=out)

    def exchanged(rows: Iterator[tuple]) -> Iterator[tuple]:
        return (p for p in pieces(rows) if p[0] <= last)

    def merge(table: pa.Table) -> pa.Table:
        """Merges a segment's sorted pieces (a merge sort, which takes the runs as it finds them)."""
        lens = pa.compute.list_value_length(table["scores"]).to_numpy()
        run = np.repeat(table["run"].to_numpy(), lens)
        scores, ids, features, weights = (pa.compute.list_flatten(table[c]).to_numpy() for c in ARRAYS)
        place = np.lexsort((run, features, ids, -scores))
        rank = first[table["segment"][0].as_py()] + 1 + np.arange(len(place))
        return flat(scores[place], ids[place], features[place], weights[place], pa.array(rank, mask=rank > drawn))

    def others(rows: Iterator[tuple]) -> Iterator[tuple]:
        for is_open, run, *arrays in rows:
            if is_open:
                got = [np.array(a, np.int64) for a in arrays]
                tail = cuts(run, got, keys.value)[last + 1]
                arrays = [a[tail:].tolist() for a in got]
            for score, doc, features, weight in zip(*arrays):
                yield doc, features, weight, score, None

    schema = "segment int, run long, " + ", ".join(f"{c} array<long>" for c in ARRAYS)
    best = map_stream(open_, columns, schema, exchanged, rows=64).groupBy("segment").applyInArrow(merge, struct)
    return best.unionByName(map_stream(runs, ["open", *columns], ROWS, others))


def resample(docs: DataFrame, target: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST, least_words: int = LEAST_WORDS,
             percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank), one row per document; rank is null where it is not drawn."""
    gains = bucket_gains(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, target_text, buckets, longest))
    runs = scratch.keep(scored_runs(docs, gains, id_col, text_col, least_words, longest, seed), "resample-runs")
    return ranked(runs, percent)
