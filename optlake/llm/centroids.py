"""Centroid clustering with heap-ordered bounds.

A vector's gap is the distance to its second nearest centroid (lower bound)
minus the distance to its own (upper bound).  When centroids move, the upper
bound grows by at most its own centroid's drift, the lower bound falls by at
most the largest drift of the others; both together are accumulated per cluster.
A vector's key is its gap plus the accumulated drift of its cluster when it was
scanned.  Each cluster keeps its vectors in a heap by key: as long as the
smallest key is above the accumulated drift, no vector of the cluster can have
changed its centroid.  Only vectors whose key has expired are popped and exactly
rescanned against all centroids; all others are not touched.

Vectors are packed into blocks, written once and bucketed by block.  A cluster's
heap is dealt over the blocks, so a hot cluster is worked on by every task.  The
heaps of a round (a key and a number a vector) are written bucketed by block too:
a round joins both without a shuffle and writes no vectors.  Rescanned vectors
that change their cluster are added to and taken from component sums, so a
round's sums come from the moved vectors alone.  The driver keeps the centroids,
their sums and the drift, whose size does not depend on the data.

All values are integers and exact: distances are int64, centroids the floored
means of decimal sums.  Bounds are doubles with a margin above their rounding
error; vectors within it (ties too) are rescanned, where the smaller number wins.

Defined results: vectors that are null, of another length than ``dim``, or hold
null or non-finite components, or components of 2^27 and more after scaling
(their distances pass a long), take no part.  Rows that repeat an id are vectors
of their own; starts are ordered by hash, then vector.  Null ids are clustered,
but no starts.  Fewer vectors than ``k``: as many clusters; none: no rows.
Columns other than id and vector are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from optlake.llm.common import Scratch, fold_partition, map_stream

DIM, SCALE, K, ROUNDS, SEED = 64, 256, 40, 5, 2
#: Vectors of a block.
BLOCK_ROWS = 4096
#: Largest component, and the one up to which products are exact as doubles.
LARGEST, EXACT = 1 << 27, 1 << 22
#: Share of a distance by which bounds are widened.
MARGIN = 1e-9
#: A block's heaps (kind 0: cluster, keys and vector numbers) and the sums of the vectors that moved (kind 1).
STATE = "block long, kind int, cluster int, keys array<double>, members array<int>, moved long, sums array<long>, scanned long"


def valid_vectors(vectors: DataFrame, id_col: str, vec_col: str, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(id, v): integer vectors of the rows that take part."""
    x = F.col(vec_col)
    limit = float(LARGEST) / scale
    fine = F.coalesce(F.forall(x, lambda e: F.coalesce(F.abs(e.cast("double")) < limit, F.lit(False))), F.lit(False))
    return vectors.where((F.size(x) == dim) & fine).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(x, lambda e: F.floor(e.cast("double") * float(scale)).cast("int")).alias("v"))


def blocks_of(rows: DataFrame) -> DataFrame:
    """(block, ids, v): up to BLOCK_ROWS vectors packed as 32-bit integers."""
    def start(got: Iterator[tuple]) -> Iterator[tuple]:
        from pyspark import TaskContext

        block, ids, held = TaskContext.get().partitionId() << 32, [], []

        def pack():
            return block, list(ids), np.array(held, "<i4").tobytes()

        for i, v in got:
            ids.append(i)
            held.append(v)
            if len(held) == BLOCK_ROWS:
                yield pack()
                ids.clear()
                held.clear()
                block += 1
        if held:
            yield pack()

    return map_stream(rows, ["id", "v"], "block long, ids array<long>, v binary", start, rows=1)


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all rows of c, as int64."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) < EXACT:
        x, c = x.astype(np.float64), c.astype(np.float64)
    else:
        x, c = x.astype(np.int64), c.astype(np.int64)
    return ((x * x).sum(1)[:, None] + (c * c).sum(1) - 2 * (x @ c.T)).astype(np.int64)


@dataclass
class Moves:
    """Centroids of a round and the drift accumulated per cluster so far."""

    centroids: np.ndarray
    drift: np.ndarray = field(default=None)

    def __post_init__(self):
        if self.drift is None:
            self.drift = np.zeros(len(self.centroids))

    def to(self, centroids: np.ndarray) -> Moves:
        """After a move: a cluster's own drift plus the largest of the others."""
        step = np.sqrt(((centroids - self.centroids).astype(np.float64) ** 2).sum(1))
        order = np.argsort(step)
        others = np.full(len(step), step[order[-1]])
        others[order[-1]] = step[order[-2]] if len(step) > 1 else 0
        return Moves(centroids, self.drift + (step + others) * (1 + MARGIN))


def scan(x: np.ndarray, moves: Moves) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller number) and heap key of every row of x."""
    far = distances(x, moves.centroids)
    own = far.argmin(1)
    upper = np.sqrt(far[np.arange(len(x)), own])
    far[np.arange(len(x)), own] = np.iinfo(np.int64).max
    lower = np.sqrt(far.min(1)) if far.shape[1] > 1 else np.full(len(x), np.inf)
    return own, lower - upper - MARGIN * (1 + upper + np.minimum(lower, upper + 1)) + moves.drift[own]


def pop_expired(heap: list[tuple], drift: float) -> list[int]:
    """Takes the members whose key is not above the accumulated drift out of a heap."""
    out = []
    while heap and heap[0][0] <= drift:
        out.append(heapq.heappop(heap)[1])
    return out


def rescan_block(x: np.ndarray, heaps: dict[int, list[tuple]], moves: Moves) -> tuple[dict[int, list], dict[int, list], int]:
    """Pops expired members of a block's heaps and scans them again.

    Returns the changed heaps, {cluster: [members gained minus lost, their component sum]} and the number of scans.
    ``heaps`` is None for a block that was never scanned."""
    k = len(moves.centroids)
    if heaps is None:
        popped, before = np.arange(len(x)), np.full(len(x), -1)
        heaps = {}
    else:
        found = [(c, m) for c in heaps for m in pop_expired(heaps[c], moves.drift[c])]
        before, popped = (np.array(a, np.int64) for a in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    if not len(popped):
        return heaps, {}, 0
    own, keys = scan(x[popped], moves)
    for c, key, m in zip(own.tolist(), keys.tolist(), popped.tolist()):
        heapq.heappush(heaps.setdefault(c, []), (key, m))
    moved = own != before
    sums = {}
    for c in range(k):
        into, out = popped[moved & (own == c)], popped[moved & (before == c)]
        if len(into) or len(out):
            sums[c] = [len(into) - len(out), x[into].sum(0, dtype=np.int64) - x[out].sum(0, dtype=np.int64)]
    return heaps, sums, len(popped)


def _matrix(block: pa.Table, dim: int) -> np.ndarray:
    return np.frombuffer(block["v"][0].as_py(), "<i4").reshape(-1, dim).astype(np.int64)


def _round(blocks: DataFrame, state: DataFrame | None, moves: Moves, dim: int) -> DataFrame:
    """STATE rows of one round."""
    struct = _parse_datatype_string(STATE)
    out = to_arrow_schema(struct)
    shared = blocks.sparkSession.sparkContext.broadcast(moves)

    def rows_of(block: int, x: np.ndarray, heaps: dict | None) -> pa.Table:
        heaps, sums, scanned = rescan_block(x, heaps, shared.value)
        rows = [(block, 0, c, [q[0] for q in h], [q[1] for q in h], None, None, None) for c, h in sorted(heaps.items()) if h]
        rows += [(block, 1, c, None, None, n, s.tolist(), None) for c, (n, s) in sorted(sums.items())]
        rows.append((block, 2, None, None, None, None, None, scanned))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)

    def first(block: pa.Table) -> pa.Table:
        return rows_of(block["block"][0].as_py(), _matrix(block, dim), None)

    def again(block: pa.Table, held: pa.Table) -> pa.Table:
        heaps = {c: list(zip(keys, members)) for c, keys, members in
                 zip(*(held[n].to_pylist() for n in ("cluster", "keys", "members")))}
        return rows_of(block["block"][0].as_py(), _matrix(block, dim), heaps)

    if state is None:
        return blocks.groupBy("block").applyInArrow(first, struct)
    heaps = state.where("kind = 0").select("block", "cluster", "keys", "members")
    return blocks.groupBy("block").cogroup(heaps.groupBy("block")).applyInArrow(again, struct)


def _moved(state: DataFrame, k: int, dim: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Members gained and component sums by cluster (Python integers), and the vectors scanned."""
    def fold(batches: Iterator[list[list]]) -> list:
        total = {}
        scans = 0
        for kinds, clusters, moved, sums, scanned in batches:
            for kind, c, n, s, m in zip(kinds, clusters, moved, sums, scanned):
                if kind == 1:
                    got = total.setdefault(c, [0, np.zeros(dim, np.int64)])
                    got[0] += n
                    got[1] += np.array(s, np.int64)
                else:
                    scans += m
        rows = [(c, at, v) for c, (n, s) in total.items() for at, v in enumerate([n, *s.tolist()])] + [(-1, 0, scans)]
        return [list(column) for column in zip(*rows)]

    parts = fold_partition(state.where("kind > 0"), ["kind", "cluster", "moved", "sums", "scanned"], "c int, at int, v long", fold)
    count, sums = np.zeros(k, object), np.zeros((k, dim), object)
    scans = 0
    for r in parts.groupBy("c", "at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect():
        if r.c < 0:
            scans = int(r.v)
        elif r.at:
            sums[r.c, r.at - 1] = int(r.v)
        else:
            count[r.c] = int(r.v)
    return count, sums, scans


@dataclass
class Clusters:
    """Result of ``cluster``: (vec_id, cluster, distance) rows, centroids, and the vectors scanned in each pass."""

    rows: DataFrame
    centroids: np.ndarray
    scanned: list[int]


def cluster(vectors: DataFrame, scratch: Scratch, k: int = K, rounds: int = ROUNDS, seed: int = SEED, dim: int = DIM,
            scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding") -> Clusters:
    """Clusters of all vectors after ``rounds`` moves of the centroids and one more assignment."""
    valid = valid_vectors(vectors, id_col, vec_col, dim, scale)
    starts = (valid.where("id is not null").withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
              .orderBy("h", "v").limit(k).collect())
    struct = _parse_datatype_string("vec_id long, cluster int, distance long")
    if not starts:
        return Clusters(vectors.sparkSession.createDataFrame([], struct), np.zeros((0, dim), np.int64), [])
    moves = Moves(np.array([r.v for r in starts], np.int64))
    blocks = scratch.keep_bucketed(blocks_of(valid), "vector-blocks", "block")
    count, sums = np.zeros(len(starts), object), np.zeros((len(starts), dim), object)
    state, scanned = None, []
    for step in range(rounds + 1):
        new = scratch.keep_bucketed(_round(blocks, state, moves, dim), "heaps", "block")
        if state is not None:
            scratch.drop(state)
        state = new
        more, parts, scans = _moved(state, len(starts), dim)
        count, sums = count + more, sums + parts
        scanned.append(scans)
        if step < rounds:
            moves = moves.to(np.array([[s // n for s in row] if n else old for row, n, old in
                                       zip(sums.tolist(), count.tolist(), moves.centroids.tolist())], np.int64))

    out = to_arrow_schema(struct)
    centroids = blocks.sparkSession.sparkContext.broadcast(moves.centroids)

    def final(block: pa.Table, held: pa.Table) -> pa.Table:
        x = _matrix(block, dim)
        own = np.zeros(len(x), np.int64)
        for c, members in zip(held["cluster"].to_pylist(), held["members"].to_pylist()):
            own[members] = c
        distance = ((x - centroids.value[own]) ** 2).sum(1)
        return pa.Table.from_arrays([block["ids"].combine_chunks().flatten(), pa.array(own, pa.int32()), pa.array(distance)], schema=out)

    held = state.where("kind = 0").select("block", "cluster", "members")
    rows = scratch.keep(blocks.groupBy("block").cogroup(held.groupBy("block")).applyInArrow(final, struct), "clusters")
    scratch.drop(blocks, state)
    return Clusters(rows, moves.centroids, scanned)


def with_inertia(found: Clusters) -> DataFrame:
    """The rows with cluster_inertia, inertia and the digest of their final centroid."""
    spark = found.rows.sparkSession
    sums = {r.cluster: r.s for r in found.rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    every = sum(sums.values())
    per = [(c, s, every, hashlib.sha256(",".join(map(str, found.centroids[c].tolist())).encode()).hexdigest())
           for c, s in sums.items()]  # a row a cluster
    facts = spark.createDataFrame(per, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.rows.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
