"""Byte-level BPE against the tokenizer library, and exact round trips."""

import hashlib

import numpy as np
import public_tokenizers
import tiktoken

from optlake.llm import bpe as B

RANKS = B.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
LIB = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def want(text):
    ids = LIB.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_edges(docs, scratch, monkeypatch):
    texts = [None, "", "a", "don't  stop \n\n now", "  ", "\U0001f600é 12345!?", "x" * 5000, "the " * 20_000, "a", "<|endoftext|>"]
    for words, tokens in ((400_000, 6_000_000), (3, 10)):  # one block, and many
        monkeypatch.setattr(B, "BLOCK_WORDS", words)
        monkeypatch.setattr(B, "BLOCK_TOKENS", tokens)
        rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (2**60 + 1, "big id")]
        got = B.encode_decode(docs(rows), RANKS, public_tokenizers.PATTERN, scratch).collect()
        assert len(got) == len(rows)
        by = {r.doc_id: r for r in got}
        for i, t in rows:
            r = by[i]
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want(t)
            assert list(r.ids) == LIB.encode_ordinary(t or "") and bytes(r.decoded) == (t or "").encode()


def test_empty_table(docs, scratch):
    assert B.encode_decode(docs([]), RANKS, public_tokenizers.PATTERN, scratch).count() == 0


def test_query(llm):
    from optlake.llm.queries import QUERIES

    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op6_byte_bpe"](llm, "/root/testdata/sf0.001").collect()}
    rows = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert got == {r.doc_id: want(r.text) for r in rows}


def test_number_packing():
    r = np.random.default_rng(0)
    for v in ([], [0], [175, 176, 177, 176 + 79 * 256 - 1, 176 + 79 * 256, 2**31], r.integers(0, 2**20, 5000), r.integers(0, 400, 999)):
        v = np.array(v, np.int64)
        assert B.unpack_numbers(B.pack_numbers(v)).tolist() == v.tolist()
        assert B._spread(B._squeeze(v)).tolist() == v.tolist()
    words = [b"", b"a", "é".encode() * 9]
    assert B._unpack_words(B._pack_words(words)) == words
