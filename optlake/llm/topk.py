"""Exact top-k inner products by no-random-access aggregation, in blocks.

Vectors are packed into blocks, written once and read in place.  Within a block
each component is a sorted list.  The lists are read sequentially, from the top
for a query's positive weights and from the bottom for negative ones, all to the
same depth.  The part of a score that has been read plus the worst and the best
value the unread entries can still have bound every candidate's score.  A query
stops reading once the upper bounds of all but a few candidates are below its
k-th score: the k-th best lower bound of the block, or the k-th final score of
the blocks that its task has read before, which is carried along.  The few that
are left are resolved to final scores.  At the last depth the lists are read to
their ends, where both bounds are the score.  Bounds for many queries are matrix
products over the read entries.

Queries come in groups of about GROUP_ROWS, which are broadcast one by one; each
is a pass over the blocks, which are never copied or shuffled.  A task gives at
most k rows per query; the final k are ranked from those.  Ties go to the
smaller id, so a candidate is only given up when its upper bound is strictly
below the k-th score.

Defined results: vectors that are null, empty, of another length than most
(the smallest of the most frequent lengths), or hold null or non-finite
components take no part.  Every row is a vector of its own: rows that repeat a
query's id are candidates for it, and a repeated query id asks once per row.
Fewer than k candidates: all of them.  Components are floor(scale * x); products
are exact while dim * (scale * max|x|)^2 < 2^53.  Null ids take no part.  An empty
table gives no rows.  Columns other than id and vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from optlake.llm.common import Scratch, map_stream

SCALE = 1024
#: Vectors of a block, queries of a group (about), queries whose bounds are held at once.
BLOCK_ROWS, GROUP_ROWS, CHUNK_ROWS = 8192, 16384, 256
#: Depths at which bounds are compared, as shares of a list.
DEPTHS = (1 / 32, 1 / 8, 1 / 4, 1 / 2, 3 / 4, 0.9, 0.97, 1)
#: A query stops reading when at most this share of the block is still open.
OPEN_SHARE = 0.02


def valid_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v): integer vectors of the rows that take part."""
    x = F.col(vec_col)
    fine = F.coalesce(F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) &
                               (F.abs(e.cast("double")) < float("inf"))), F.lit(False))
    rows = vectors.where(F.col(id_col).isNotNull() & (F.size(x) > 0) & fine).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(x, lambda e: F.floor(e.cast("double") * float(scale)).cast("long")).alias("v"))
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (usual.d if usual else 0))


def blocks_of(rows: DataFrame) -> DataFrame:
    """(block, ids, v): up to BLOCK_ROWS vectors packed as 64-bit integers.  A row is known by its block and place."""
    def start(got: Iterator[tuple]) -> Iterator[tuple]:
        from pyspark import TaskContext

        block, ids, held = TaskContext.get().partitionId() << 16, [], []
        for i, v in got:
            ids.append(i)
            held.append(v)
            if len(held) == BLOCK_ROWS:
                yield block, ids, np.array(held, "<i8").tobytes()
                block, ids, held = block + 1, [], []
        if held:
            yield block, ids, np.array(held, "<i8").tobytes()

    return map_stream(rows, ["id", "v"], "block long, ids array<long>, v binary", start, rows=1)


class Lists:
    """The sorted lists of a block."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        order = np.argsort(-x, axis=0, kind="stable")  # best first
        self.x, self.place = x, np.empty_like(order)
        np.put_along_axis(self.place, order, np.arange(n)[:, None].repeat(x.shape[1], 1), 0)
        self.lists = np.take_along_axis(x, order, 0)

    def bounds(self, up: np.ndarray, down: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all candidates when t entries of every list are read; ``up``, ``down``: the
        positive and the negative weights of the queries."""
        n, best, worst = len(self.x), self.lists[0], self.lists[-1]
        head, tail = self.place < t, self.place >= n - t  # read from the top, from the bottom
        low = (up @ worst + down @ best)[:, None] + up @ np.where(head, self.x - worst, 0).T + down @ np.where(tail, self.x - best, 0).T
        if t >= n:
            return low, low
        # an unread entry is between the worst value and the one at the current depth
        room_up, room_down = up * (self.lists[t] - worst), down * (self.lists[n - t - 1] - best)
        return low, low + room_up @ (~head).T.astype(float) + room_down @ (~tail).T.astype(float)


def nra_block(lists: Lists, own: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int, ids: np.ndarray):
    """Top k of a block for every query: a list of (candidates, scores), and the depth at which each stopped reading.

    q: [m, d] queries; own: each query's own place in the block, or -1; floor: the k-th score it has already."""
    n, m = len(lists.x), len(q)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    alive, found, stopped = np.arange(m), [None] * m, np.ones(m)
    for share in DEPTHS:
        t = n if share == 1 else int(n * share)
        if not len(alive):
            break
        if t < n and t <= k:
            continue
        low, high = lists.bounds(up[alive], down[alive], t)
        mine = own[alive]
        at = np.flatnonzero(mine >= 0)
        low[at, mine[at]] = high[at, mine[at]] = -np.inf
        kth = np.partition(low, n - k, axis=1)[:, n - k] if n > k else np.full(len(alive), -np.inf)
        open_ = (high >= np.maximum(kth, floor[alive])[:, None]) & (high > -np.inf)
        done = (open_.sum(1) <= max(4 * k, OPEN_SHARE * n)) | (t >= n)
        for i in np.flatnonzero(done):
            cols = np.flatnonzero(open_[i])
            s = lists.x[cols] @ q[alive[i]]  # final scores of what is left
            top = np.lexsort((ids[cols], -s))[:k]
            found[alive[i]], stopped[alive[i]] = (cols[top], s[top]), share
        alive = alive[~done]
    return found, stopped


def _scan(blocks: DataFrame, group: dict, k: int) -> DataFrame:
    """(asked, query_id, vec_id, score): each task's k best of one group of queries over its blocks."""
    shared = blocks.sparkSession.sparkContext.broadcast(group)

    def start(rows: Iterator[tuple]) -> Iterator[tuple]:
        asked = shared.value
        m = len(asked["id"])
        best = [(np.zeros(0, np.int64), np.zeros(0))] * m  # (ids, scores) of every query so far
        floor = np.full(m, -np.inf)
        for block, ids, packed in rows:
            ids = np.array(ids, np.int64)
            lists = Lists(np.frombuffer(packed, "<i8").reshape(len(ids), -1).astype(np.float64))
            place = np.where(asked["block"] == block, asked["place"], -1)
            for a in range(0, m, CHUNK_ROWS):
                part = slice(a, a + CHUNK_ROWS)
                found, _ = nra_block(lists, place[part], asked["v"][part], floor[part], k, ids)
                for j, (cols, s) in enumerate(found, a):
                    if len(cols):
                        i, s = np.concatenate([best[j][0], ids[cols]]), np.concatenate([best[j][1], s])
                        top = np.lexsort((i, -s))[:k]
                        best[j] = i[top], s[top]
                        if len(top) == k:
                            floor[j] = s[top[-1]]
        for j, (i, s) in enumerate(best):
            for vec, score in zip(i.tolist(), s.tolist()):
                yield int(asked["row"][j]), int(asked["id"][j]), vec, int(score)

    return map_stream(blocks, ["block", "ids", "v"], "asked long, query_id long, vec_id long, score long", start)


def top_k(vectors: DataFrame, scratch: Scratch, k: int = 10, every: int = 100, id_col: str = "vec_id",
          vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score) for the queries whose id is divisible by ``every``."""
    blocks = scratch.keep(blocks_of(valid_vectors(vectors, id_col, vec_col, scale)), "topk-blocks")
    places = F.filter(F.sequence(F.lit(0), F.size("ids") - 1), lambda i: F.get("ids", i) % every == 0)
    sizes = blocks.agg(F.sum(F.size(places)).alias("m")).first()
    groups = max(1, -(-(sizes.m or 0) // GROUP_ROWS))
    asked = blocks.select("block", "v", "ids", F.explode(places).alias("place"))
    width = F.octet_length("v") / F.size("ids")
    asked = asked.select("block", "place", F.get("ids", F.col("place")).alias("id"),
                         F.substring(F.col("v"), (F.col("place") * width + 1).cast("int"), width.cast("int")).alias("v"))
    asked = scratch.keep(asked.withColumn("grp", F.pmod(F.xxhash64("block", "place"), F.lit(groups))), "topk-queries")
    out = None
    for g in range(groups):
        got = asked.where(F.col("grp") == g).select("block", "place", "id", "v").toArrow()  # about GROUP_ROWS rows
        if not got.num_rows:
            continue
        block, place = got["block"].to_numpy(), got["place"].to_numpy()
        group = {"block": block, "place": place, "id": got["id"].to_numpy(), "row": block << 13 | place,  # a block has at most 2^13 rows
                 "v": np.frombuffer(b"".join(got["v"].to_pylist()), "<i8").reshape(got.num_rows, -1).astype(np.float64)}
        found = _scan(blocks, group, k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    return (out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
