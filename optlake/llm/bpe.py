"""Byte-level BPE encoding and decoding by a global distinct-word shuffle.

1. Explode: each task splits its texts into pre-tokens and closes a *block*
   whenever enough distinct words are gathered.  A block keeps, per text, the
   positions as an array of block-local word numbers (by falling frequency, so
   most take a byte), and its distinct words dealt into parts by word hash (so a
   frequent word is one row per block).
2. Encode: the words are shuffled by hash; each distinct word of the corpus is
   encoded once, in the one task that owns its hash, whatever its frequency.
3. Join back: the ids return to the blocks that asked for them.
4. Reassemble: texts and ids of a block meet (cogroup by block); the local word
   numbers pick the ids in order.  Decoding joins the ids with the token-byte
   table, which is bounded by the vocabulary and read by every task.

The exploded form is written to the shared scratch folder once, bucketed by
block: both the word shuffle and the reassembly read it, the positions are never
shuffled, and a lost executor re-reads it.  A task holds one block at a time.  Defined results: null and empty texts have no ids
and decode to no bytes; very long texts stay whole (a block holds at least one
text); repeated rows give repeated results; an empty table gives no rows.  Columns
other than the text and those kept are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from optlake.llm.common import Scratch, give_back, map_stream

#: A block closes at this many distinct words or pre-tokens.
BLOCK_WORDS, BLOCK_TOKENS = 250_000, 3_000_000
#: Texts of a row of a block.
TEXTS_PER_ROW = 64
#: Parts by word hash: at least so many, and one for so many texts, so that a part's distinct words fit a task.
WORD_PARTS, TEXTS_PER_PART = 64, 50_000


def load_ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _squeeze(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as zstd-compressed byte planes."""
    v = np.ascontiguousarray(values, dtype="<u4")
    return zstandard.compress(v.view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _spread(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


def _frames(parts: list[bytes]) -> bytes:
    packed = [zstandard.compress(p, 6) for p in parts]
    return np.array([len(p) for p in packed], "<u4").tobytes() + b"".join(packed)


def _unframe(data: bytes, n: int) -> list[bytes]:
    ends = np.cumsum(np.frombuffer(data, "<u4", n), dtype=np.int64) + 4 * n
    return [zstandard.decompress(data[a:b]) for a, b in zip([4 * n, *ends[:-1].tolist()], ends.tolist())]


#: Word numbers below ONE take a byte; the next TWO * 256 take two, led by ONE and more; others five, led by 255.
ONE, TWO = 176, 79


def pack_numbers(v: np.ndarray) -> bytes:
    """Word numbers, mostly small, as compressed byte planes."""
    v = v.astype(np.int64)
    q = v - ONE
    two, more = (q >= 0) & (q < TWO * 256), q >= TWO * 256
    lead = np.where(two, ONE + (q >> 8), np.where(more, 255, v)).astype(np.uint8)
    rest = (q[more] - TWO * 256).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return _frames([lead.tobytes(), (q[two] & 255).astype(np.uint8).tobytes(), rest.tobytes()])


def unpack_numbers(data: bytes) -> np.ndarray:
    lead, second, rest = (np.frombuffer(x, np.uint8) for x in _unframe(data, 3))
    out = lead.astype(np.int64)
    two, more = (lead >= ONE) & (lead < 255), lead == 255
    out[two] = ONE + ((out[two] - ONE) << 8 | second)
    out[more] = ONE + TWO * 256 + np.ascontiguousarray(rest.reshape(4, -1).T).view("<u4").ravel()
    return out


def _pack_words(words: list[bytes]) -> bytes:
    return _frames([np.array([len(w) for w in words], "<u4").tobytes(), b"".join(words)])


def _unpack_words(data: bytes) -> list[bytes]:
    lens, raw = _unframe(data, 2)
    ends = np.cumsum(np.frombuffer(lens, "<u4"), dtype=np.int64)
    return [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def explode_words(docs: DataFrame, keep: list[str], text_col: str, pattern: str, word_parts: int = WORD_PARTS) -> DataFrame:
    """Blocks: rows of TEXTS_PER_ROW texts (part -1: kept columns, sizes, positions) and a row per word part."""
    def start(rows: Iterator[tuple]) -> Iterator[tuple]:
        from pyspark import TaskContext

        split = regex.compile(pattern).findall
        task, serial = TaskContext.get().partitionId(), 0
        words: dict[str, int] = {}
        number, held, tokens = words.setdefault, [], 0

        def close():
            block = task << 32 | serial
            often = np.bincount(np.concatenate([p for _, p in held]), minlength=len(words))
            rank = np.empty(len(words), np.int32)
            rank[np.argsort(-often, kind="stable")] = np.arange(len(words))
            for a in range(0, len(held), TEXTS_PER_ROW):
                some = held[a:a + TEXTS_PER_ROW]
                sizes = np.array([len(p) for _, p in some], "<u4")
                yield (block, -1, *map(list, zip(*[k for k, _ in some])), _squeeze(sizes),
                       pack_numbers(rank[np.concatenate([p for _, p in some])]))
            held.clear()
            parts: list[list[tuple[int, bytes]]] = [[] for _ in range(word_parts)]
            for w, r in zip(words, rank.tolist()):
                w = w.encode()
                parts[xxhash.xxh3_64_intdigest(w) % word_parts].append((r, w))
            for k, p in enumerate(parts):
                if p:
                    p.sort()
                    yield (block, k, *([None] * len(keep)), _squeeze(np.diff([r for r, _ in p], prepend=0)),
                           _pack_words([w for _, w in p]))

        for *kept, text in rows:
            positions = np.array([number(w, len(words)) for w in split(text or "")], dtype=np.int32)
            tokens += len(positions)
            held.append((kept, positions))
            if len(words) >= BLOCK_WORDS or tokens >= BLOCK_TOKENS:
                yield from close()
                words.clear()
                tokens, serial = 0, serial + 1
        if held:
            yield from close()

    types = dict(docs.dtypes)
    fields = "".join(f"`{c}` array<{types[c]}>, " for c in keep)
    return map_stream(docs, [*keep, F.col(text_col).alias("__text")],
                      f"block long, part int, {fields}numbers binary, data binary", start, rows=64)


def encode_words(parts: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(block, part, numbers, counts, ids): every distinct word of a part is encoded once."""
    shared = parts.sparkSession.sparkContext.broadcast(ranks)  # bounded by the vocabulary

    def start(rows: Iterator[tuple]) -> Iterator[tuple]:
        import tiktoken

        one = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})._encode_single_piece
        now, done = None, {}
        for part, block, numbers, words in rows:
            if part != now:  # rows come by part, so each part's words are known only while it is read
                now, done = part, {}
            got = []
            for w in _unpack_words(words):
                ids = done.get(w)
                if ids is None:
                    ids = done[w] = one(w)
                got.append(ids)
            counts = np.array([len(x) for x in got], dtype="<u4")
            flat = np.fromiter((i for x in got for i in x), dtype="<u4", count=int(counts.sum()))
            yield block, part, numbers, _squeeze(counts), _squeeze(flat)

    dealt = parts.repartition("part").sortWithinPartitions("part", "block")
    return map_stream(dealt, ["part", "block", "numbers", "data"],
                      "block long, part int, numbers binary, counts binary, ids binary", start, rows=8)


class TokenBytes:
    """The token-byte table as one buffer; joins ids with it."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        table = [b""] * size
        for b, i in ranks.items():
            table[i] = b
        self.table = table

    def decode(self, ids) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))


def encode_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, scratch: Scratch, keep: list[str] | None = None,
                  text_col: str = "text", with_ids: bool = True, with_decoded: bool = True) -> DataFrame:
    """Ids and decoded bytes of every text.

    Columns: those of ``keep`` (doc_id by default), n_tokens, ids_sha256 and
    decoded_sha256, and with ``with_ids`` ids (array), with ``with_decoded`` decoded
    (binary).  A text is decoded in any case; its bytes leave the task only where they are asked for.
    """
    keep = keep or ["doc_id"]
    types = dict(docs.dtypes)
    word_parts = max(WORD_PARTS, docs.count() // TEXTS_PER_PART)
    exploded = scratch.keep_bucketed(explode_words(docs, keep, text_col, pattern, word_parts), "bpe-blocks", "block")
    ids = encode_words(exploded.where("part >= 0").select("part", "block", "numbers", "data"), ranks, pattern)
    texts = exploded.where("part < 0").select("block", *keep, "numbers", "data")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    fields = "".join(f"`{c}` {types[c]}, " for c in keep)
    more = ", ids array<int>" * with_ids + ", decoded binary" * with_decoded
    table: list[TokenBytes] = []

    struct = _parse_datatype_string(f"{fields}n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
    out = to_arrow_schema(struct)

    def gather(columns) -> np.ndarray:
        return np.concatenate([np.zeros(0, "<u4"), *(_spread(x) for x in columns.to_pylist())])

    def reassemble(left: pa.Table, right: pa.Table) -> pa.Table:
        if not table:
            table.append(TokenBytes(shared.value))
        flat, counts = gather(right["ids"]), gather(right["counts"]).astype(np.int64)
        numbers = np.concatenate([np.zeros(0, np.int64), *(np.cumsum(_spread(x), dtype=np.int64) for x in right["numbers"].to_pylist())])
        first = np.concatenate(([0], np.cumsum(counts)))
        slot = np.empty(len(numbers), np.int64)  # place of a word number's ids
        slot[numbers] = np.arange(len(numbers))
        made: list[pa.RecordBatch] = []
        for row in range(left.num_rows):  # TEXTS_PER_ROW texts at a time become Arrow columns
            cut = np.cumsum(_spread(left["numbers"][row].as_py()), dtype=np.int64)[:-1]
            kept = [left[c][row].values for c in keep]
            n_tokens, ids_hash, plain_hash, some, plains = [], [], [], [], []
            for at in np.split(slot[unpack_numbers(left["data"][row].as_py())], cut):
                n = counts[at]
                # the ids of a word stand at first[k] ... first[k] + counts[k]; position j of the text starts at begin[j]
                begin = np.concatenate(([0], np.cumsum(n)))
                got = flat[np.arange(begin[-1]) + np.repeat(first[at] - begin[:-1], n)]
                plain = table[0].decode(got.tolist())
                n_tokens.append(len(got))
                ids_hash.append(hashlib.sha256(got.astype("<u4").tobytes()).hexdigest())
                plain_hash.append(hashlib.sha256(plain).hexdigest())
                if with_ids:
                    some.append(got.astype(np.int32))
                if with_decoded:
                    plains.append(plain)
            columns = [*kept, n_tokens, ids_hash, plain_hash]
            if with_ids:
                ends = np.concatenate(([0], np.cumsum(n_tokens))).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(ends, np.concatenate(some)))
            if with_decoded:
                columns.append(plains)
            made.append(pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                                                    for c, f in zip(columns, out)], schema=out))
        give_back()
        return pa.Table.from_batches(made, schema=out)

    return texts.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(reassemble, struct)
