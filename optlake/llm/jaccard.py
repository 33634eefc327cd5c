"""Exact n-gram Jaccard join in size-banded tiles with bitmap signatures.

A document is the set of its distinct word shingles, held as a sorted array of
64-bit hashes.  Documents are linked when 100 * intersection >= percent * union.

1. Common shingles: each task reports the shingles it met in several different
   texts of a chunk; the most frequent of all (at most LISTED) are put at the end
   of one global order, all others stand before them by hash.  Any order is right;
   this one keeps passages that many documents share out of the keys.
2. Keys: sets of similarity ``percent`` share one of their first
   n - ceil(percent * n / 100) + 1 shingles in any common order.  Those are a
   set's keys.  Equal sets (128-bit digest) are one class, named by its least id.
3. Neighbours: of the least members of its keys' groups, each set first meets the
   one it shares most keys with.  Then it meets the others, and its predecessors
   in the groups by size, as far as they are in other components (large groups
   are ordered in parts of about GROUP_ROWS).
4. Tiles: a group whose members lie in several components is not finished.  The
   members of all unfinished groups with the same largest component are
   gathered; those outside it (outsiders) meet the members of other components in
   tiles.  A tile holds outsiders of one size band and members of that band and
   the bands beside it, no more than TILE_ROWS and TILE_BYTES of each.
5. Bound: a bitmap signature has a bit per hash position, the parity of the
   shingles that fall there.  Two sets differ in at least as many shingles as
   their bitmaps in bits, so overlap <= (sizes - differing bits) / 2.  Pairs under
   the overlap they need are dropped by bit counts alone; the others are settled
   by intersecting their sorted arrays.

Of the pairs that the bound lets through, those with the most room are settled
first, a few for each two components (``settle``): as soon as two components are
joined, their other pairs need no sets.

No pair at or above the similarity is lost: keys are complete, the bound is from
above, sizes a band apart cannot link.  A group of near copies costs its
neighbours, plus outsiders times members bit counts; it never becomes rows for
all pairs.  Intersections are of 64-bit hashes.

Defined results: null and empty texts and texts without words have the empty set
and no links; fewer words than a shingle make one shingle of all.  Very long
texts are read whole.  Rows that share an id are one node and carry its links.
Null ids take no part in links (component null).  An empty table gives no rows.
Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from optlake.llm.common import Scratch, broadcast_if_few, map_columns, map_stream
from optlake.llm.neardup import components

SIZE, PERCENT = 5, 80
#: Shingles of a chunk, different texts of it that make a shingle common, and the most that are listed (8 bytes each).
CHUNK, MET, LISTED = 1 << 22, 2, 1 << 20
#: Members of a part of a group in which neighbours are taken.
GROUP_ROWS = 8192
#: Outsiders or members of a tile, and bytes of their bitmaps.
TILE_ROWS, TILE_BYTES = 2048, 4 << 20
#: Bits of a bitmap for each shingle (at least; a power of two in all).
BITS = 4
#: Words a task remembers the hashes of.
_MEMO = 1 << 17
_TAKE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, as UTF-8."""
    return (text or "").encode().lower().split()


class Shingles:
    """Sorted arrays of the distinct shingle hashes of texts."""

    def __init__(self, size: int):
        self.size, self.known = size, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        if len(self.known) > _MEMO:
            self.known.clear()
        known, hashes = self.known, []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            hashes.append(h)
        h = np.array(hashes, np.uint64)
        size = min(self.size, len(h))
        if not size:
            return h
        out = np.full(len(h) - size + 1, size, np.uint64)
        for j in range(size):  # order counts: every step mixes what it has before it takes the next word
            out = (out ^ h[j:j + len(out)]) * _TAKE
            out ^= out >> np.uint64(29)
            out *= np.uint64(0xBF58476D1CE4E5B9)
            out ^= out >> np.uint64(32)
        return np.unique(out)


def bitmap(shingles: np.ndarray) -> bytes:
    """Parity of the shingles at each of 2^b positions, BITS or more for each shingle, in 64-bit words."""
    bits = max(64, 1 << int(BITS * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles >> np.uint64(7)).astype(np.int64) & bits - 1, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def fold_to(maps: np.ndarray, words: int) -> np.ndarray:
    """Rows of bitmaps folded to fewer 64-bit words: positions that meet add their parities."""
    while maps.shape[1] > words:
        half = maps.shape[1] // 2
        maps = maps[:, :half] ^ maps[:, half:]
    return maps


def needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Overlap that sets of sizes a and b need: ceil(percent * (a + b) / (100 + percent))."""
    return -(-percent * (a + b) // (100 + percent))


def overlap_bound(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Upper bounds of the overlaps of all rows of a with all rows of b (bitmaps of one width)."""
    differ = np.zeros((len(a), len(b)), np.int64)
    for w in range(a.shape[1]):
        differ += np.bitwise_count(a[:, w, None] ^ b[None, :, w])
    return (na[:, None] + nb[None, :] - differ) // 2


def pair_bound(x: bytes, y: bytes, m: int, n: int) -> int:
    """``overlap_bound`` of one pair, whatever its widths."""
    a, b = int.from_bytes(x, "little"), int.from_bytes(y, "little")
    wide, narrow = max(len(x), len(y)), min(len(x), len(y))
    if len(x) < len(y):
        a, b = b, a
    while wide > narrow:
        wide //= 2
        a = a >> 8 * wide ^ a & (1 << 8 * wide) - 1
    return (m + n - (a ^ b).bit_count()) // 2


def band_of(n: Column, percent: int) -> Column:
    """Size band: sizes more than one band apart cannot reach the similarity."""
    return F.floor(F.log(n.cast("double")) / float(-np.log(percent / 100)) + 1e-9).cast("int")


def common_shingles(docs: DataFrame, size: int, text_col: str) -> np.ndarray:
    """The shingles met most often, rarest first."""
    def start(rows: Iterator[tuple]) -> Iterator[tuple]:
        of, held, total = Shingles(size), {}, 0

        def report():
            found, often = np.unique(np.concatenate(list(held.values())), return_counts=True)
            some = np.flatnonzero(often >= MET)
            return zip(found[some].view(np.int64).tolist(), often[some].tolist())

        for (text,) in rows:
            s = of(text)
            digest = xxhash.xxh3_128_digest(s.tobytes())
            if len(s) and digest not in held:  # copies of a text count once
                held[digest] = s
                total += len(s)
            if total >= CHUNK:
                yield from report()
                held, total = {}, 0
        if held:
            yield from report()

    found = map_stream(docs, [text_col], "s long, n long", start, rows=10_000).groupBy("s").agg(F.sum("n").alias("n"))
    return found.orderBy(F.desc("n"), "s").limit(LISTED).toArrow()["s"].to_numpy()[::-1].view(np.uint64).copy()


def key_count(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


class Order:
    """The global order: shingles that are not listed by hash, then the listed ones."""

    def __init__(self, listed: np.ndarray):
        self.sorted = np.sort(listed)
        self.rank = np.argsort(listed, kind="stable")

    def first(self, shingles: np.ndarray, count: int) -> np.ndarray:
        if not len(self.sorted):
            return shingles[:count]
        at = np.searchsorted(self.sorted, shingles)
        at[at == len(self.sorted)] = 0
        common = self.sorted[at] == shingles
        rare = shingles[~common][:count]
        if len(rare) == count:
            return rare
        late = shingles[common]
        return np.concatenate([rare, late[np.argsort(self.rank[at[common]])][:count - len(rare)]])


def features(docs: DataFrame, listed: np.ndarray, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bits, keys): the digest of the whole set, its bitmap and its keys."""
    shared = docs.sparkSession.sparkContext.broadcast(listed)

    def start():
        of, order = Shingles(size), Order(shared.value)

        def step(ids, texts):
            n, a, b, maps, keys = [], [], [], [], []
            for t in texts:
                s = of(t)
                digest = xxhash.xxh3_128_digest(s.tobytes())
                n.append(len(s))
                a.append(int.from_bytes(digest[:8], "little", signed=True))
                b.append(int.from_bytes(digest[8:], "little", signed=True))
                maps.append(bitmap(s) if len(s) else None)
                keys.append(order.first(s, key_count(len(s), percent)).view(np.int64) if len(s) else None)
            return [ids, n, a, b, maps, keys]

        return step

    return map_columns(docs, [F.col(id_col).cast("long"), text_col],
                       "doc_id long, n_shingles long, set_a long, set_b long, bits binary, keys array<long>", start)


def within_bound(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b, room): the pairs whose sizes and bitmaps allow the similarity, and the bound's thousandths of the overlap
    they need.  ``nodes``: rep, n, bits."""
    left = nodes.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ma"))
    right = nodes.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("mb"))
    both = pairs.join(left, "a").join(right, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))

    def start():
        def step(a, b, na, nb, ma, mb):
            out = [], [], []
            for i in range(len(a)):
                bound, need = pair_bound(ma[i], mb[i], na[i], nb[i]), needed(na[i], nb[i], percent)
                if bound >= need:
                    for column, v in zip(out, (a[i], b[i], 1000 * bound // need)):
                        column.append(v)
            return list(out)

        return step

    return map_columns(both, ["a", "b", "na", "nb", "ma", "mb"], "a long, b long, room long", start) \
        .groupBy("a", "b").agg(F.max("room").alias("room"))


def intersect(pairs: DataFrame, docs: DataFrame, scratch: Scratch, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs whose sorted arrays have the similarity."""
    ends = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text")).join(broadcast_if_few(ends), "rep", "left_semi")

    def arrays():
        of = Shingles(size)
        return lambda reps, given: [reps, [of(t).tobytes() for t in given]]

    sets = scratch.keep(map_columns(texts, ["rep", "text"], "rep long, s binary", arrays).distinct(), "jaccard-sets")

    def start():
        def step(a, b, sa, sb):
            good = []
            for i in range(len(a)):
                x, y = np.frombuffer(sa[i], np.uint64), np.frombuffer(sb[i], np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            return [[v for v, g in zip(c, good) if g] for c in (a, b)]

        return step

    # b, the greater id, is in few pairs: its set travels with the pair, to that of a
    met = pairs.join(sets.select(F.col("rep").alias("b"), F.col("s").alias("sb")), "b") \
        .join(sets.select(F.col("rep").alias("a"), F.col("s").alias("sa")), "a")
    links = scratch.keep(map_columns(met, ["a", "b", "sa", "sb"], "a long, b long", start).distinct(), "jaccard-links")
    scratch.drop(sets)
    return links


def apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components, with them (ca, cb).  ``comp``: rep, component of linked ends."""
    of_a, of_b = (comp.select(F.col("rep").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
    named = pairs.join(of_a, "a", "left").join(of_b, "b", "left")
    return named.withColumn("ca", F.coalesce("ca", "a")).withColumn("cb", F.coalesce("cb", "b")).where("ca <> cb")


def merged(comp: DataFrame, joins: DataFrame, scratch: Scratch) -> DataFrame:
    """Components after joins (a, b) of whole components."""
    new = scratch.keep(components(joins, scratch), "jaccard-joined").select(F.col("rep").alias("component"), F.col("component").alias("root"))
    known = comp.join(new, "component", "left").select("rep", F.coalesce("root", "component").alias("component"))
    # ends that had no link before are components of their own, named by themselves
    alone = new.select(F.col("component").alias("rep"), F.col("root").alias("component")).join(comp.select("rep"), "rep", "left_anti")
    return scratch.keep(known.unionByName(alone), "jaccard-components")


def settle(pairs: DataFrame, comp: DataFrame, docs: DataFrame, scratch: Scratch, size: int, percent: int, id_col: str,
           text_col: str) -> DataFrame:
    """Components after all links among the candidate pairs (a, b, room).

    In rounds: of the pairs between each two components those with the most room are intersected, eight times as many
    as in the round before; pairs whose ends have come together are left out."""
    take = 1
    while True:
        between = apart(pairs, comp)
        two = Window.partitionBy(F.least("ca", "cb"), F.greatest("ca", "cb")).orderBy(F.desc("room"), "a", "b")
        chosen = scratch.keep(between.withColumn("place", F.row_number().over(two)).where(F.col("place") <= take).drop("place"), "jaccard-chosen")
        if not chosen.limit(1).count():
            return comp
        links = intersect(chosen.select("a", "b"), docs, scratch, size, percent, id_col, text_col)
        rest = scratch.keep(pairs.join(chosen.select("a", "b"), ["a", "b"], "left_anti"), "jaccard-pairs")
        if links.limit(1).count():
            joins = chosen.join(links, ["a", "b"]).select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
            new = merged(comp, joins, scratch)
            scratch.drop(comp)
            comp = new
        scratch.drop(pairs, chosen, links)
        pairs, take = rest, 8 * take


def unfinished(members: DataFrame) -> DataFrame:
    """(main, rep, n, component): members of groups in several components, gathered by the group's largest component."""
    parts = members.groupBy("key", "component").agg(F.count("*").alias("n"))
    open_ = (parts.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("n", "component")).alias("top"))
             .where("parts > 1").select("key", F.col("top.component").alias("main")))
    return members.join(open_, "key").select("main", "rep", "n", "component").distinct()


def tile_pairs(rows: DataFrame, nodes: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """(a, b, room): pairs of outsiders and members of other components that the bound lets through."""
    sized = rows.withColumn("band", band_of(F.col("n"), percent)).join(nodes.select("rep", "n", F.octet_length("bits").alias("bytes")), ["rep", "n"])
    rows = scratch.keep(sized, "jaccard-tiles")
    outside = rows.where("component <> main")
    # columns of their own, so that both sides of the tiles can be told apart
    near = rows.select(F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("band"),
                       *[F.col(c).alias(c) for c in ("main", "rep", "n", "component", "bytes")])

    def parts(some: DataFrame, name: str) -> DataFrame:
        count = F.greatest(F.ceil(F.count("*") / TILE_ROWS), F.ceil(F.sum("bytes") / TILE_BYTES))
        return some.groupBy("main", "band").agg(count.cast("int").alias(name))

    cut = parts(outside, "nx").join(parts(near, "ny"), ["main", "band"])

    def spread(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def own(n):
        return F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")

    key, columns = ["main", "band", "bx", "by"], ["rep", "n", "component", "bits"]
    xs = outside.join(cut, ["main", "band"]).select("main", "band", own("nx").alias("bx"), spread("ny").alias("by"), F.lit(0).alias("side"), *columns[:3])
    ys = near.join(cut, ["main", "band"]).select("main", "band", spread("nx").alias("bx"), own("ny").alias("by"), F.lit(1).alias("side"), *columns[:3])
    placed = scratch.keep(xs.unionByName(ys), "jaccard-places")  # bitmaps come to the rows that have a place in a tile
    dealt = placed.join(nodes.select("rep", "n", "bits"), ["rep", "n"])
    # most tiles are small: a task reads its tiles as one sorted stream and holds one of them at a time
    dealt = dealt.repartition(*key).sortWithinPartitions(*key, "side")

    def start(got: Iterator[tuple]) -> Iterator[tuple]:
        now, sides = None, ([], [])
        for main, band, bx, by, side, *row in got:
            if (main, band, bx, by) != now:
                yield from tile(*sides, percent)
                now, sides = (main, band, bx, by), ([], [])
            sides[side].append(row)
        yield from tile(*sides, percent)

    return map_stream(dealt, [*key, "side", *columns], "a long, b long, room long", start, rows=10_000) \
        .groupBy("a", "b").agg(F.max("room").alias("room"))


def tile(left: list, right: list, percent: int) -> Iterator[tuple]:
    """(a, b, room) of the pairs of a tile's outsiders and members (rep, n, component, bits) that the bound lets through."""
    if not left or not right:
        return
    if len(left) * len(right) <= 64:
        for x, nx, cx, mx in left:
            for y, ny, cy, my in right:
                if cx != cy and 100 * min(nx, ny) >= percent * max(nx, ny):
                    need, bound = needed(nx, ny, percent), pair_bound(mx, my, nx, ny)
                    if bound >= need:
                        yield min(x, y), max(x, y), 1000 * bound // need
        return
    (x, nx, cx, mx), (y, ny, cy, my) = ([np.array(c, np.int64) if k < 3 else c for k, c in enumerate(zip(*rows))] for rows in (left, right))
    width = min(map(len, mx + my)) // 8
    mx, my = (np.concatenate([fold_to(np.frombuffer(m, np.uint64)[None, :], width) for m in maps]) for maps in (mx, my))
    for a in range(0, len(y), 256):
        near = slice(a, a + 256)
        need, bound = needed(nx[:, None], ny[None, near], percent), overlap_bound(mx, my[near], nx, ny[near])
        good = (bound >= need) & (cx[:, None] != cy[None, near])
        good &= 100 * np.minimum(nx[:, None], ny[None, near]) >= percent * np.maximum(nx[:, None], ny[None, near])
        i, j = np.nonzero(good)
        yield from zip(np.minimum(x[i], y[near][j]).tolist(), np.maximum(x[i], y[near][j]).tolist(), (1000 * bound[i, j] // need[i, j]).tolist())


def jaccard_join(docs: DataFrame, scratch: Scratch, size: int = SIZE, percent: int = PERCENT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per input row."""
    listed = common_shingles(docs, size, text_col)
    feats = scratch.keep(features(docs, listed, size, percent, id_col, text_col), "jaccard-features")
    own = feats.where("n_shingles > 0 and doc_id is not null")
    classes = scratch.keep(own.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep")), "jaccard-classes")
    named = scratch.keep(own.join(classes.select("set_a", "set_b", F.col("rep").alias("doc_id")), ["set_a", "set_b", "doc_id"], "left_semi")
                         .select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "bits", "keys"), "jaccard-named")
    entries = named.select(F.explode("keys").alias("key"), "rep", "n")
    heads = entries.groupBy("key").agg(F.count("*").alias("size"), F.min("rep").alias("head")).where("size > 1")
    groups = scratch.keep(entries.join(heads, "key"), "jaccard-groups")
    nodes = scratch.keep(named.select("rep", "n", "bits").join(groups.select("rep").distinct(), "rep", "left_semi").distinct(), "jaccard-nodes")
    scratch.drop(named)

    def ordered(x, y) -> list[Column]:
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    how = (docs, scratch, size, percent, id_col, text_col)
    none = nodes.select("rep", F.col("rep").alias("component")).limit(0)
    most = groups.where("head <> rep").groupBy("rep", "head").agg(F.count("*").alias("keys")).groupBy("rep").agg(
        F.max_by("head", F.struct("keys", -F.col("head"))).alias("head"))
    first = scratch.keep(within_bound(most.select(*ordered("head", "rep")).distinct(), nodes, percent), "jaccard-pairs")
    comp = settle(first, none, *how)

    # a hot group's neighbours are taken in parts; what that leaves apart is left to the tiles
    part = F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / GROUP_ROWS))
    order = Window.partitionBy("key", "part").orderBy("n", "rep")
    near = groups.withColumn("part", part).select("rep", "head", F.lag("rep").over(order).alias("before"))
    near = near.select(F.explode(F.array("before", "head")).alias("x"), "rep").where("x <> rep").select(*ordered("x", "rep")).distinct()
    near = within_bound(apart(near, comp).select("a", "b"), nodes, percent)
    comp = settle(scratch.keep(near, "jaccard-pairs"), comp, *how)

    members = groups.select("key", "rep", "n").join(comp, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    open_ = scratch.keep(unfinished(members), "jaccard-open")
    if open_.limit(1).count():
        comp = settle(scratch.keep(tile_pairs(open_, nodes, scratch, percent), "jaccard-pairs"), comp, *how)
    scratch.drop(groups, nodes, open_)
    found = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return (feats.select("doc_id", "n_shingles", "set_a", "set_b").join(classes, ["set_a", "set_b"], "left").join(comp, "rep", "left")
            .select("doc_id", "n_shingles", found.alias("component_id")))
