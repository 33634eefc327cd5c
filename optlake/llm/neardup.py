"""Near-duplicate documents by MinHash and a multi-index Hamming join.

A document is the set of its distinct word shingles.  Documents are linked
when the Jaccard similarity of their full sets reaches ``percent`` / 100.

1. Signature: ``CHUNKS * CHUNK`` b-bit minhashes per document.  Documents with
   equal sets (by a 128-bit digest of the whole set) become one class, whose
   smallest id stands for it, so exact copies never meet as pairs.
2. Multi-index: signatures are split into CHUNKS chunks.  If two signatures
   differ in fewer than 2 * CHUNKS symbols, some chunk has at most one error
   (pigeonhole).  Enumerating that error as a left-out symbol gives one key per
   symbol; every pair under the distance shares a key.  Pairs past it that
   share a key are candidates too.
3. Star: in each bucket of a key all members are compared with its smallest
   member only.  Links are confirmed on the full shingle sets of the texts and
   joined into components.
4. Rest: a bucket of three or more whose members lie in several components is
   not finished.  The members outside its largest component (the outsiders) are
   compared with all members of other components.  Where that is few pairs they
   are formed, kept if their signatures differ in at most MAX_ERRORS symbols,
   and confirmed.  Larger buckets are gathered by their largest component:
   outsiders and members meet in tiles of bounded size, a tile counts the common
   shingles of all its pairs through an inverted list, and only links come out.

A large group of near copies so costs a star per bucket and its outsiders'
tiles, never rows for all its pairs, and no link between different texts is
lost to skew.  At a similarity of 0.8 and 10 chunks of 5 symbols, a pair shares
no key with probability 2e-6.

Links and components stay in Spark; components are found by the alternating
large-star and small-star steps, each written to the shared scratch folder.

Defined results: null and empty texts, and texts without words, have the empty
set, and no links; a text with fewer words than a shingle is one shingle of all
its words.  Very long texts are read whole.  A repeated id with different texts
is one node per text, and all of them carry that id.  Null ids take no part in
links (component null, kept).  An empty table gives no rows.  Columns other than
id and text are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from optlake.llm.common import Scratch, broadcast_if_few, map_columns

#: Chunks of a signature, symbols of a chunk (16 bits each).
CHUNKS, CHUNK = 10, 5
SYMBOLS = CHUNKS * CHUNK
#: Differing symbols beyond which unfinished buckets' pairs are not compared (5 standard deviations at 0.8).
MAX_ERRORS = 24
#: Outsiders times members of an unfinished bucket up to which its pairs are formed.
FEW_PAIRS = 256
#: Shingles of a tile's outsiders and of its members.
TILE_OUTSIDE, TILE_MEMBERS = 1 << 19, 1 << 21
#: Word hashes a task remembers (about 20 MB).
_MEMO = 1 << 17


def words_lower(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, as UTF-8."""
    return (text or "").encode().lower().split()


def shingle_set(text: str | None, size: int) -> set:
    """The shingles of a text as strings (exact)."""
    w = words_lower(text)
    if len(w) < size:
        return {b" ".join(w)} if w else set()
    return set(map(b" ".join, zip(*(w[i:] for i in range(size)))))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Shingle hashes, signatures and keys of texts."""

    def __init__(self, size: int):
        self.size = size
        self.known: dict[bytes, int] = {}
        odd = _mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64)) | np.uint64(1)
        self.odd = odd
        at = np.arange(SYMBOLS).reshape(CHUNKS, CHUNK)
        # key (c, j): the symbols of chunk c without the j-th
        self.others = np.array([np.delete(at[c], j) for c in range(CHUNKS) for j in range(CHUNK)])
        self.salt = _mix(np.arange(1000, 1000 + SYMBOLS, dtype=np.uint64))

    def shingles(self, text: str | None) -> np.ndarray:
        """Distinct 64-bit hashes of the shingles."""
        words = words_lower(text)
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > _MEMO:
            known.clear()
        out = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            out.append(h)
        h = np.array(out, dtype=np.uint64)
        size = min(self.size, len(h))
        n = len(h) - size + 1
        mixed = np.full(n, size, dtype=np.uint64)
        for j in range(size):
            mixed = _mix(mixed * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n])
        return np.unique(mixed)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        low = np.full(SYMBOLS, np.iinfo(np.uint64).max, dtype=np.uint64)
        for a in range(0, len(shingles), 1024):
            low = np.minimum(low, (shingles[a:a + 1024, None] * self.odd).min(0))
        return (_mix(low) & np.uint64(0xFFFF)).astype("<u2")

    def keys(self, signature: np.ndarray) -> np.ndarray:
        s = signature.astype(np.uint64)[self.others]
        packed = np.zeros(SYMBOLS, np.uint64)
        for j in range(CHUNK - 1):
            packed = packed << np.uint64(16) | s[:, j]
        return _mix(packed ^ self.salt).view(np.int64)


def features(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, signature): the set digest is of all its shingles."""
    def start():
        hasher = Hasher(size)

        def step(ids, texts):
            n, a, b, sig = [], [], [], []
            for t in texts:
                s = hasher.shingles(t)
                digest = xxhash.xxh3_128_digest(s.tobytes())
                n.append(len(s))
                a.append(int.from_bytes(digest[:8], "little", signed=True))
                b.append(int.from_bytes(digest[8:], "little", signed=True))
                sig.append(hasher.signature(s).tobytes() if len(s) else None)
            return [ids, n, a, b, sig]

        return step

    return map_columns(docs, [id_col, text_col],
                       "doc_id long, n_shingles long, set_a long, set_b long, signature binary", start)


def bucket_keys(classes: DataFrame, size: int) -> DataFrame:
    """(key, rep) for every key of every class."""
    def start():
        hasher = Hasher(size)

        def step(reps, sigs):
            return [reps, [hasher.keys(np.frombuffer(s, "<u2")) for s in sigs]]

        return step

    keyed = map_columns(classes, ["rep", "signature"], "rep long, keys array<long>", start)
    return keyed.select(F.explode("keys").alias("key"), "rep")


def texts_of(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rep, text) of the documents in ``ids`` (column rep); their ids are broadcast if they are few enough."""
    plain = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text"))
    return plain.join(broadcast_if_few(ids.distinct()), "rep", "left_semi")


def verify(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union.  ``texts``: rep, text."""
    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))

    def start():
        last: list = [None, set()]

        def step(a, b, ta, tb):
            good = []
            for tx, ty in zip(ta, tb):
                if last[0] != tx:  # an id may have several texts
                    last[:] = [tx, shingle_set(tx, size)]
                p, q = last[1], shingle_set(ty, size)
                both = len(p & q) if min(len(p), len(q)) * 100 >= percent * max(len(p), len(q)) else 0
                good.append(bool(both) and 100 * both >= percent * (len(p) + len(q) - both))
            return [[x for x, g in zip(a, good) if g], [x for x, g in zip(b, good) if g]]

        return step

    return map_columns(pairs.join(right, "b").join(left, "a"), ["a", "b", "text_a", "text_b"], "a long, b long", start)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(rep, component): smallest reachable id of every linked id, by alternating stars."""
    edges = scratch.keep(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .distinct(), "edges")
    while not _is_star_forest(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: the neighbours above a node go to the smallest of it and its neighbours
        large = scratch.keep(both.join(low, "a").where("b > a and b <> m")
                             .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-star")
        # small star: a node and its neighbours below go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("x"), "m").where("x <> m")
        new = scratch.keep(small.select(F.col("x").alias("a"), F.col("m").alias("b")).distinct(), "small-star")
        scratch.drop(edges, large)
        edges = new
    ends = edges.select("b").distinct().select(F.col("b").alias("rep"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("rep"), F.col("b").alias("component")).unionByName(ends)


def _is_star_forest(edges: DataFrame) -> bool:
    """Every node has one edge down, to a node that has none."""
    if edges.groupBy("a").count().where("count > 1").limit(1).count():
        return False
    return not edges.select(F.col("b").alias("a")).distinct().join(edges, "a", "left_semi").limit(1).count()


def _open_buckets(members: DataFrame) -> DataFrame:
    """(key, rep, component, main, few) of buckets of three or more members in several components."""
    parts = members.groupBy("key", "component").agg(F.count("*").alias("n"))
    open_ = (parts.groupBy("key").agg(F.count("*").alias("parts"), F.sum("n").alias("members"),
                                      F.max(F.struct("n", "component")).alias("top"))
             .where("parts > 1 and members > 2")
             .select("key", F.col("top.component").alias("main"),
                     ((F.col("members") - F.col("top.n")) * F.col("members") <= FEW_PAIRS).alias("few")))
    return members.select("key", "rep", "component").join(open_, "key")


def _few_pairs(buckets: DataFrame) -> DataFrame:
    """(a, b): outsiders against members of other components, bucket by bucket."""
    outside = buckets.where("component <> main").select("key", F.col("rep").alias("x"), F.col("component").alias("cx"))
    return (outside.join(buckets.select("key", "rep", "component"), "key").where("cx <> component")
            .select(F.least("x", "rep").alias("a"), F.greatest("x", "rep").alias("b")).distinct())


def common_counts(outside: list[np.ndarray], member: np.ndarray, index: tuple) -> np.ndarray:
    """Common shingles of one member and every outsider of a tile."""
    vocab, first, owner = index
    at = np.searchsorted(vocab, member)
    at[at == len(vocab)] = 0
    hit = at[vocab[at] == member]
    num = first[hit + 1] - first[hit]
    take = np.arange(num.sum()) + np.repeat(first[hit] - (np.cumsum(num) - num), num)
    return np.bincount(owner[take], minlength=len(outside))


def inverted(outside: list[np.ndarray]) -> tuple:
    """(shingles, starts of their owners, owners) of the outsiders' sets."""
    flat = np.concatenate(outside)
    owner = np.repeat(np.arange(len(outside)), [len(s) for s in outside])
    order = np.argsort(flat, kind="stable")
    vocab, first = np.unique(flat[order], return_index=True)
    return vocab, np.append(first, len(flat)), owner[order]


def _tiles(buckets: DataFrame, docs: DataFrame, nodes: DataFrame, scratch: Scratch, size: int, percent: int, id_col: str,
           text_col: str) -> DataFrame:
    """(a, b): links between outsiders and members of the buckets, gathered by their largest component."""
    rows = scratch.keep(buckets.select("main", "rep", "component").distinct().join(nodes.select("rep", "n"), "rep"), "tile-rows")

    def start():
        hasher = Hasher(size)
        return lambda reps, texts: [reps, [hasher.shingles(t).tobytes() for t in texts]]

    sets = map_columns(texts_of(docs, rows.select("rep"), id_col, text_col), ["rep", "text"], "rep long, shingles binary", start)
    cut = rows.groupBy("main").agg(F.ceil(F.sum("n") / TILE_MEMBERS).cast("int").alias("ny"),
                                   F.ceil(F.sum(F.when(F.col("component") != F.col("main"), F.col("n"))) / TILE_OUTSIDE).cast("int").alias("nx"))
    full = scratch.keep(rows.join(sets.distinct(), "rep").join(cut, "main"), "tile-sets")

    def spread(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def own(n):
        return F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")

    members = full.select("main", spread("nx").alias("bx"), own("ny").alias("by"), "rep", "component", "shingles")
    outside = full.where("component <> main").select("main", own("nx").alias("bx"), spread("ny").alias("by"), "rep", "component", "shingles")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def tile(xs: pa.Table, ys: pa.Table) -> pa.Table:
        found = []
        if xs.num_rows and ys.num_rows:
            reps, comps = xs["rep"].to_numpy(), xs["component"].to_numpy()
            held = [np.frombuffer(s, np.uint64) for s in xs["shingles"].to_pylist()]
            sizes, index = np.array([len(s) for s in held]), inverted(held)
            for y, c, s in zip(ys["rep"].to_pylist(), ys["component"].to_pylist(), ys["shingles"].to_pylist()):
                s = np.frombuffer(s, np.uint64)
                both = common_counts(held, s, index)
                good = (100 * both >= percent * (sizes + len(s) - both)) & (comps != c)
                found += [(min(x, y), max(x, y)) for x in reps[good].tolist()]
        return pa.table([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], schema=schema)

    key = ["main", "bx", "by"]
    return outside.groupBy(*key).cogroup(members.groupBy(*key)).applyInArrow(tile, "a long, b long").distinct()


def close_signatures(pairs: DataFrame) -> DataFrame:
    """Distinct (a, b) whose signatures differ in at most MAX_ERRORS symbols."""
    def start():
        def step(a, b, sa, sb):
            if not a:
                return [[], []]
            x = np.frombuffer(b"".join(sa), "<u2").reshape(-1, SYMBOLS)
            y = np.frombuffer(b"".join(sb), "<u2").reshape(-1, SYMBOLS)
            near = np.flatnonzero((x != y).sum(1) <= MAX_ERRORS)
            return [[a[i] for i in near], [b[i] for i in near]]

        return step

    return map_columns(pairs, ["a", "b", "sa", "sb"], "a long, b long", start).distinct()


def near_duplicates(docs: DataFrame, scratch: Scratch, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row."""
    feats = scratch.keep(features(docs, size, id_col, text_col), "shingles")
    classes = scratch.keep(
        feats.where("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b")
        .agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"), F.min("n_shingles").alias("n")), "classes")
    nodes = classes.select("rep", "signature", "n")
    rows = bucket_keys(classes, size)
    heads = rows.groupBy("key").agg(F.count("*").alias("members"), F.min("rep").alias("head")).where("members > 1")
    buckets = scratch.keep(rows.join(heads.select("key", "head"), "key"), "buckets")

    star = buckets.where("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct()
    star = scratch.keep(_candidates(star, nodes, percent), "star")
    ends = star.select(F.col("a").alias("rep")).unionByName(star.select(F.col("b").alias("rep")))
    texts = scratch.keep(texts_of(docs, ends, id_col, text_col), "texts")
    links = scratch.keep(verify(star, texts, size, percent), "links")
    comp = scratch.keep(components(links, scratch), "components")
    scratch.drop(texts)

    members = buckets.join(comp, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    open_ = scratch.keep(_open_buckets(members), "open-buckets")
    few = _candidates(_few_pairs(open_.where("few")).join(star, ["a", "b"], "left_anti"), nodes, percent)
    many = open_.where("not few")
    if many.limit(1).count():
        few = few.unionByName(_tiles(many, docs, nodes, scratch, size, percent, id_col, text_col)).distinct()
    more = scratch.keep(few, "rest")
    if more.limit(1).count():
        ends = more.select(F.col("a").alias("rep")).unionByName(more.select(F.col("b").alias("rep")))
        texts = scratch.keep(texts_of(docs, ends, id_col, text_col), "texts")
        rest = scratch.keep(verify(more, texts, size, percent), "links")
        scratch.drop(texts)
        if rest.limit(1).count():
            comp = scratch.keep(components(links.unionByName(rest), scratch), "components")
    scratch.drop(buckets, star, open_, more)
    own = F.col("doc_id").isNotNull()
    return (feats.select("doc_id", "n_shingles", "set_a", "set_b")
            .join(classes.select("set_a", "set_b", "rep"), ["set_a", "set_b"], "left").join(comp, "rep", "left")
            ).select("doc_id", "n_shingles", F.when(own, F.coalesce("component", "rep", "doc_id")).alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))


def _candidates(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) whose set sizes allow the similarity and whose signatures are close."""
    a = nodes.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa"))
    b = nodes.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb"))
    both = pairs.join(a, "a").join(b, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return close_signatures(both)
