"""Personal data: base spans, the tagger's gradients, added spans, redaction."""

import random
import re
import time

import numpy as np
import pytest

from optlake.llm import pii as P

SMALL = "/root/testdata/sf0.1"


# The contract's patterns as they are written there, tried at every place.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_ip(text):
    return [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]


def plain_spans(text):
    digits = lambda m: [int(c) for c in m[0] if c in "0123456789"]

    def valid(d):
        double = [n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n) for i, n in enumerate(reversed(d))]
        return 16 <= len(d) <= 19 and sum(double) % 10 == 0

    return ([(0, *m.span()) for m in EMAIL.finditer(text)] + [(1, a, b) for a, b in plain_ip(text)]
            + [(2, *m.span()) for m in CARD.finditer(text) if valid(digits(m))]
            + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15])


def test_base_rules_equal_the_plain_patterns():
    """Random strings over the patterns' own characters, and every text of the small corpus."""
    r = random.Random(11)
    for alphabet in ("a1.@-", "12.", "0123456789 -", "+1()-. ", "a@.é+1 -(", "25.@a_%+"):
        for _ in range(1500):
            t = "".join(r.choice(alphabet) for _ in range(r.randrange(0, 60)))
            assert P.base_spans(t) == plain_spans(t), t
    cards = ["4111 1111 1111 1111", "41111111111111112", "4111-1111-1111-1111-003", "1 2.3.4.255.6.7.8.9.1"]
    for _ in range(500):
        t = "".join(r.choice([*cards, " ", "-", ".", "x", "+1", "(0)"]) for _ in range(r.randrange(1, 8)))
        assert P.base_spans(t) == plain_spans(t), t


def test_small_corpus_equals_the_plain_patterns():
    import pyarrow.parquet as pq

    for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist():
        assert P.base_spans(t or "") == plain_spans(t or "")


@pytest.mark.parametrize("unit", ["7", "a", "1.", "a@", "+1", "1 ", "@", "a@b.c ", "x at y dot z "])
def test_long_runs_take_linear_time(unit):
    """A megabyte of one run: base rules and spelled addresses in seconds."""
    text = unit * (1_000_000 // len(unit)) + " joe@example.org"
    t0 = time.time()
    spans = P.base_spans(text)
    spelled = P.spelled_spans(text)
    assert time.time() - t0 < 20
    assert (0, len(text) - 15, len(text)) in spans or unit in ("a@b.c ",) and spans
    assert bool(spelled) == (unit[0] == "x")


def test_spelled_names_of_any_length():
    for name in ("j" * 150, "a.b dot c" + "d" * 200, "x dot " * 60 + "y"):
        t = f"write {name} at example dot org now"
        (kind, a, b, _), = P.spelled_spans(t)
        assert (kind, t[a:b]) == (0, f"{name} at example dot org")
        assert name not in P.reconcile(P.spelled_spans(t), t, []) and P.reconcile(P.spelled_spans(t), t, []) == [(0, a, b)]


def test_base_rules():
    t = "mail a.b@c-d.org, ip 10.0.0.255 and 1.2.3.256, card 4111 1111 1111 1111, phone +1 (607) 555-1595 x +12"
    spans = [(P.KINDS[k], t[a:b]) for k, a, b in P.base_spans(t)]
    assert spans == [("email", "a.b@c-d.org"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (607) 555-1595")]
    assert P.base_spans("000.000.0000.0255") == [(1, 0, 17)] and plain_ip("000.000.0000.0255")
    assert P.base_spans("1." * 3 + "9" * 5000) == []
    assert P.base_spans("4111 1111 1111 1112 ") == []


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 30, (3, P.SPAN)), rng.integers(0, P.TAGS, (3, P.SPAN))
    tagger = P.Tagger()
    tagger.p["tr"] = rng.standard_normal((P.TAGS, P.TAGS)).astype(np.float32) * 0.1
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    _, g = tagger.gradients(x, y)
    for name in ("emb", "wf", "uf", "bb", "wo", "tr"):
        at = tuple(int(rng.integers(0, s)) for s in tagger.p[name].shape) if name != "emb" else (int(x[0, 0]), 1)
        eps = 1e-2
        old = tagger.p[name][at]
        tagger.p[name][at] = old + eps
        up, _ = tagger.gradients(x, y)
        tagger.p[name][at] = old - eps
        down, _ = tagger.gradients(x, y)
        tagger.p[name][at] = old
        assert abs((up - down) / (2 * eps) - g[name][at]) < 2e-2 * max(1, abs(g[name][at])), name


def test_windows_cover_every_anchor():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n = int(rng.integers(1, 700))
        text = "".join(rng.choice(list("abc 1@"), n, p=[.3, .3, .2, .18, .01, .01]))
        starts = P.window_starts(text, n)
        every = [s for s in range(0, max(1, n), P.STRIDE) if s <= max(0, -(-(n - P.SPAN) // P.STRIDE)) * P.STRIDE]
        want = [s for s in every if any(c in "1@" for c in text[s:s + P.SPAN])]
        assert starts.tolist() == want


def test_reconcile_is_global():
    text = "0" * 100
    found = [(3, 0, 30, 90.0), (3, 20, 45, 70.0), (1, 10, 15, 1e3)]
    assert P.reconcile(found, "x" * 100, []) == []  # nothing plausible in letters
    phones = "call 607-555-1595 or 607-555-1596"
    assert P.reconcile([(3, 5, 17, 99.0), (3, 21, 33, 99.0)], phones, [(3, 21, 33)]) == [(3, 5, 17)]
    assert text


@pytest.fixture(scope="module")
def tagger(spark):
    from optlake.llm.common import prepare

    return P.train_tagger(prepare(spark).read.parquet(f"{SMALL}/documents.parquet"))


def test_learns_disguised_spans(tagger, llm):
    rows = llm.read.parquet(f"{SMALL}/documents.parquet").where("doc_id % 5 = 3").select("doc_id", "text").collect()
    windows = [w for r in rows for w in P.training_windows(r.text, r.doc_id + 12345) if w[1]]
    x, y = P._arrays(windows)
    tags, _ = tagger.decode(x)
    f = 2 * ((tags == y) & (y > 0)).sum() / ((tags > 0).sum() + (y > 0).sum())
    assert f > 0.75, f
    (_, spans), = P.find_spans(["call (607) 555-1595 now"], tagger)
    assert [P.KINDS[k] for k, _, _ in spans] == ["phone"]


def test_find_and_redact(docs, llm, tagger):
    long = "word " * 40_000 + "a@b.org " + "word " * 10
    texts = [None, "", "nothing here", "a@b.org and 10.0.0.1", "a@b.org and 10.0.0.1", long, "é +1 (607) 555-1595"]
    got = {r.doc_id: r for r in P.find_pii(docs(texts), tagger).collect()}
    assert got[0].spans == got[1].spans == got[2].spans == "" and got[0].base_sha256 == got[1].base_sha256
    assert got[3].spans.startswith("email:0:7,ip:12:20") and got[3].spans == got[4].spans
    assert (got[5].n_email, got[6].n_phone) == (1, 1) and "email:200000:200007" in got[5].spans
    clean = P.redact(docs(texts), tagger)
    assert clean.columns == docs([]).columns
    out = {r.doc_id: r.text for r in clean.collect()}
    assert out[0] is None and out[3] == "[EMAIL] and [IP]" and out[6] == "é [PHONE]" and out[2] == texts[2]
    assert P.find_pii(docs([]), None).count() == 0 and P.train_tagger(docs([])) is None
    assert [r.spans for r in P.find_pii(docs(["a@b.org"]), None).collect()] == ["email:0:7"]


def test_base_spans_of_corpus(llm, tagger):
    rows = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in P.find_pii(rows, tagger).collect()}
    for r in rows.collect():
        base = P.base_spans(r.text or "")
        assert [got[r.doc_id][f"n_{k}"] for k in P.KINDS] == [sum(s[0] == i for s in base) for i in range(4)]
        assert set(P._joined(base).split(",")) <= set(got[r.doc_id].spans.split(","))


def test_spelled_addresses_are_found_and_redacted(docs, tagger):
    texts = ["write to john.smith at example dot org for help", "we met at home, dot your letters", "ask maria dot lopez at mail dot net please"]
    found = [spans for _, spans in P.find_spans(texts, tagger)]
    assert [P.KINDS[k] for s in found for k, _, _ in s] == ["email", "email"] and not found[1]
    out = {r.doc_id: r.text for r in P.redact(docs(texts), tagger).collect()}
    assert "[EMAIL]" in out[0] and "example" not in out[0] and "lopez" not in out[2] and out[1] == texts[1]


def test_rare_personal_data_still_trains(docs, monkeypatch):
    """One document in 400 holds a base span, and the sample is a hundredth."""
    monkeypatch.setattr(P, "SAMPLE_DOCS", 4)
    monkeypatch.setattr(P, "STEPS", 1)
    rows = [f"plain text {i}" if i else "mail a.b@c-d.org" for i in range(400)]
    assert P.train_tagger(docs(rows)) is not None and P.train_tagger(docs(rows[1:])) is None
